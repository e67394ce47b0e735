"""Compliance rules, redaction, reconciliation and column profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators.merge import UPDATE, merge_rows
from quayside.operators.skew import lookup_join
from quayside.session import durable


def rule_broken(column: str, acceptable: str) -> Column:
    """V1: a value outside the accepted list. The value is lower-cased, the list is not; a missing
    value never breaks a list; a rule that accepts only NULL is broken by any value (F26)."""
    tokens = acceptable.split(";")
    values = [t for t in tokens if t != "NULL"]
    if not values:
        return F.col(column).isNotNull()
    return F.coalesce(~F.lower(F.col(column).cast("string")).isin(*values), F.lit(False))


def violations(df: DataFrame, key: str, rules: Sequence[tuple[int, str, str]]) -> DataFrame:
    """V1: (rule_id, record_id) of every broken rule; all rules in one scan of the table.

    ``rules`` are (id, column, accepted values) from configuration.
    """
    hits = F.array(
        *[F.when(rule_broken(column, ok), F.lit(rule).cast("long")) for rule, column, ok in rules]
    )
    return (
        df.select(F.explode(F.array_compact(hits)).alias("rule_id"), F.col(key).alias("record_id"))
    )


def new_violations(found: DataFrame, open_set: DataFrame) -> DataFrame:
    """Violations that are not open already."""
    active = open_set.filter("active").select("rule_id", "record_id")
    return found.join(active, ["rule_id", "record_id"], "left_anti")


def reopen_violations(open_set: DataFrame, found: DataFrame) -> DataFrame:
    """V2: the violations table after a check: new ones added, closed ones active again."""
    staged = found.select("rule_id", "record_id", F.lit(True).alias("active"))
    merged = merge_rows(open_set.select("rule_id", "record_id", "active"), staged,
                        ["rule_id", "record_id"], unique=True)
    return merged.withColumn("reopened", F.col("action") == UPDATE)


def redact(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Only columns with a rule remain; ``Hash`` gives the MD5 of the text (NULL stays NULL,
    F35), ``Increment`` adds one, ``drop`` removes, any other rule keeps the column."""
    def apply(name: str, rule: str) -> Column:
        if rule == "Hash":
            return F.md5(F.col(name).cast("string")).alias(name)
        if rule == "Increment":
            return (F.col(name) + 1).cast(df.schema[name].dataType).alias(name)
        return F.col(name)

    kept = [c for c in df.columns if rules.get(c, "drop") != "drop"]
    return df.select(*[apply(c, rules[c]) for c in kept])


def profile_lengths(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A5: longest text of each column; NULL has no length (F16). One aggregate over one scan."""
    columns = list(columns or df.columns)
    one = df.agg(*[F.max(F.length(F.col(c).cast("string"))).cast("long").alias(c) for c in columns])
    return one.unpivot([], columns, "column_name", "max_len")


def merge_profiles(profiles: Sequence[DataFrame]) -> DataFrame:
    """The longest over all files for each column name."""
    every = reduce(DataFrame.unionByName, profiles)
    return every.groupBy("column_name").agg(F.max("max_len").alias("max_len"))


# A sketch this near to the row count may belong to a key; with 2**12 registers its standard error is
# below 2 %.
SKETCH_BITS, NEAR = 12, 0.9


def about(text: Column) -> Column:
    """About how many distinct texts there are."""
    return F.coalesce(F.hll_sketch_estimate(F.hll_sketch_agg(text, F.lit(SKETCH_BITS))), F.lit(0).cast("long"))


def digest(text: Column) -> list[Column]:
    """Two independent 64-bit hashes that stand for a text: 16 bytes travel whatever its length."""
    return [F.xxhash64(F.lit(salt), text).alias(f"h{salt}") for salt in (1, 2)]


def column_profile(df: DataFrame, sketched: bool = True) -> DataFrame:
    """Rows, missing, least and greatest text and about how many distinct texts of each column: one
    row per task is shuffled, no cells."""
    texts = {c: F.col(c).cast("string") for c in df.columns}
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[
        F.struct(
            F.count(t).alias("n"), F.min(t).alias("low"), F.max(t).alias("high"),
            (about(t) if sketched else F.lit(None).cast("long")).alias("about")).alias(c)
        for c, t in texts.items()])
    return one.select("_rows", F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("p")) for c in df.columns]))).select(
        "column_name", F.col("_rows").alias("row_count"), (F.col("_rows") - F.col("p.n")).alias("null_count"),
        F.col("p.low").alias("min_text"), F.col("p.high").alias("max_text"), F.col("p.about").alias("about"))


def distinct_counts(texts: Mapping[str, Column], df: DataFrame, name: str) -> DataFrame:
    """Exact distinct texts of some expressions in one scan; equal ones are combined in the tasks,
    and what is shuffled is a digest each."""
    # Of both hashes of a missing text nothing is counted: the row is left out.
    cells = df.select(*[F.when(t.isNotNull(), F.struct(*digest(t))).alias(k) for k, t in texts.items()])
    found = cells.unpivot([], list(texts), name, "_digest").filter("_digest IS NOT NULL").distinct()
    return found.groupBy(name).agg(F.count(F.lit(1)).alias("distinct_count"))


def column_stats(df: DataFrame, exact: str = "all") -> DataFrame:
    """Rows, missing, distinct, least and greatest text of each column, and whether the column
    is a key.

    A first scan gives all but the distinct counts, and a sketch of these. With ``exact="keys"``
    only columns without missing texts whose sketch lies near the row count are counted exactly,
    as no other can be a key (the sketch would be off by five standard errors); for the others the
    sketch is the count. With ``"all"`` every column is counted, by digests of its texts.
    """
    if exact not in ("all", "keys"):
        raise ValueError(f"exact is all or keys, not {exact!r}")
    if exact == "all":
        profile, names = column_profile(df, False), df.columns
    else:
        profile = durable(column_profile(df), "profile")  # a row per column
        possible = (F.col("null_count") == 0) & (F.col("about") >= NEAR * F.col("row_count"))
        names = [r[0] for r in profile.filter(possible).select("column_name").collect()]
    if not names:
        counted = profile.withColumn("distinct_count", F.lit(None).cast("long"))
    else:
        counts = distinct_counts({c: F.col(c).cast("string") for c in names}, df, "column_name")
        counted = profile.join(F.broadcast(counts), "column_name", "left")
    missing = F.lit(0).cast("long") if exact == "all" else F.col("about")
    return counted.select(
        "column_name", "row_count", "null_count", F.coalesce("distinct_count", missing).alias("distinct_count"),
        "min_text", "max_text",
        (F.col("row_count") == F.coalesce("distinct_count", F.lit(-1 if exact == "keys" else 0))).alias("is_key"))


def is_key(df: DataFrame, columns: Sequence[str]) -> bool:
    """V3: whether the columns identify a row. One scan counts rows, missing values and a sketch;
    only if these allow a key are the digests of the keys counted."""
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    key = F.to_json(F.struct(*[F.col(c) for c in columns]))
    seen = df.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~whole).alias("missing"),
        about(key).alias("about")).first()
    if seen["missing"] or seen["about"] < NEAR * seen["n"]:
        return False
    counted = distinct_counts({"key": key}, df, "name").first()
    return (counted["distinct_count"] if counted else 0) == seen["n"]


def index_cardinality(df: DataFrame, indexes: Mapping[str, Sequence[str]]) -> DataFrame:
    """Distinct values of the joined text of each index's columns (F32: without a separator);
    one scan for all indexes, digests are shuffled."""
    texts = {name: F.concat_ws("", *[F.col(c).cast("string") for c in cols]) for name, cols in indexes.items()}
    names = df.sparkSession.createDataFrame([(n,) for n in indexes], "index_name string")
    return names.join(distinct_counts(texts, df, "index_name"), "index_name", "left").select(
        "index_name", F.coalesce("distinct_count", F.lit(0)).alias("cardinality"))


def index_cardinality_approx(df: DataFrame, indexes: Mapping[str, Sequence[str]]) -> DataFrame:
    """A8 for very large tables: a sketch per index, one scan and no shuffle of values."""
    one = df.agg(
        *[F.approx_count_distinct(F.concat_ws("", *[F.col(c).cast("string") for c in cols])).alias(name)
          for name, cols in indexes.items()]
    )
    return one.unpivot([], list(indexes), "index_name", "cardinality")


def reconcile(recorded: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Rows recorded per table or file against rows present, with the difference."""
    return (
        recorded.groupBy(key).agg(F.sum("rows").alias("rows_recorded"))
        .join(present.groupBy(key).agg(F.sum("rows").alias("rows_present")), key, "full_outer")
        .fillna(0, ["rows_recorded", "rows_present"])
        .withColumn("difference", F.col("rows_present") - F.col("rows_recorded"))
    )


def anti_diff(left: DataFrame, right: DataFrame, on: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Left rows without a partner on the right."""
    pairs = on.items() if isinstance(on, Mapping) else [(c, c) for c in on]
    keys = right.select(*[F.col(r).alias(lft) for lft, r in pairs]).distinct()
    return lookup_join(left, keys, [lft for lft, _ in pairs], "left_anti")
