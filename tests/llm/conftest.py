import pytest
from pyspark.sql import functions as F

LANGS = {
    "en": "the of and that with house river under water morning people never thought again",
    "de": "der die und nicht einer haus wasser morgen leute schon wieder gedacht über straße",
    "fr": "le la les des une maison rivière matin peuple jamais pensé encore être où très",
}


def prose(lang, seed, n):
    words = LANGS[lang].split()
    out, state = [], seed * 7919 + 13
    for k in range(n):
        state = (state * 1103515245 + 12345) % 2**31
        word = words[state % len(words)]
        out.append(word.capitalize() if k % 8 == 0 else word + "." if k % 8 == 7 else word)
    return " ".join(out)


def corpus():
    """Texts of three languages, copies, near copies, junk, and every odd case."""
    rows = []
    for k in range(90):
        lang = list(LANGS)[k % 3]
        rows.append((k, prose(lang, k, 30 + 7 * (k % 11)) + f" end{k}.", lang))
    rows += [(100 + k, rows[k][1], rows[k][2]) for k in range(6)]                     # copies
    rows += [(110 + k, rows[40][1] + f" more{k}.", "en") for k in range(5)]            # near copies
    rows += [(120 + k, " ".join(f"w{k}x{j}###" for j in range(40)), "en") for k in range(40)]  # junk
    rows += [
        (200, None, "en"), (201, "", "en"), (202, " \t\n ", None), (203, "123 456 !!", "de"), (204, "a", "en"),
        (205, "É", None), (206, "<|endoftext|> x<|endoftext|>", "en"), (207, "don't we'll    tab\tend　", "en"),
        (208, "日本語のテキスト 漢字", None), (209, ("long passage of words " * 3000).strip(), "en"),
        (210, "x" * 9000, "en"), (211, " " * 5000 + "y", None), (212, "😀" * 700, "en"), (213, "É" * 3000 + "\n" * 99, "fr"),
        (214, "same same same same same same same same same same same same", "en"),
        (3, rows[3][1], rows[3][2]), (None, "no id here, but some text of words.", "en"), (None, None, None),
    ]
    return rows


@pytest.fixture(scope="session")
def texts():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, texts):
    """With extra columns whose names the operators use themselves."""
    frame = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    return frame.select(
        "doc_id", "text", "lang", F.lit("s").alias("source"), F.lit(1).alias("score"), F.lit("x").alias("id"),
        F.lit(2).alias("n"), F.lit("p").alias("part"), F.lit(None).cast("string").alias("component"),
    ).repartition(3)


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)
