"""Load and publish configurations."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from typing import Any

import yaml

from quayside.functions.names import column_list as parse_columns
from quayside.functions.paths import java_regex

# Settings an entry hands on to the next one of its path, with their first values.
STICKY: dict[str, Any] = {
    "table_name": None, "file_delimiter": None, "column_list": None, "schema_name": None,
    "use_header": False, "has_header": True, "append_file_id": False, "upsert_function_name": None,
    "file_encoding": "UTF8", "header_row_location": None, "quoted_header": True,
    "unzip_again": False, "new_delimiter": None, "table_name_extract": None,
}
# Settings an entry takes from its path, but does not hand on.
INHERITED: dict[str, Any] = {"reprocess": True, "limit_rows": None}
# Settings that exist on the entry only.
OWN = ("column_list2", "pre_action", "post_action", "append_crc", "keys", "target_schema")


@dataclass(frozen=True)
class MappingRow:
    """One configured file pattern and what to do with its files."""

    order: int
    path: str
    project_name: str
    file_regex: str
    file_type: str
    steps: tuple[str, ...] = ()
    settings: Mapping[str, Any] = field(default_factory=dict)

    def __getattr__(self, name: str) -> Any:
        if name in {f.name for f in fields(MappingRow)}:
            raise AttributeError(name)
        try:
            return self.settings[name]
        except KeyError:
            raise AttributeError(name) from None

    @property
    def columns(self) -> list[str] | None:
        return parse_columns(self.settings["column_list"])

    @property
    def header_row(self) -> int:
        return int(self.settings["header_row_location"] or 0)

    @property
    def delimiter(self) -> str:
        """The delimiter of the incoming file; a new one only asks for P8's quoting."""
        return self.settings["file_delimiter"] or ","


def _row_limit(value: Any) -> int | None:
    """a number or its digits; anything else means no limit."""
    text = str(value).strip()
    return int(text) if text.isdigit() else None


def _steps(items: list[dict] | None) -> list[str]:
    return [str(i["logic"]).rsplit(".", 1)[-1] for i in items or []]


def read_mappings(text: str) -> list[MappingRow]:
    """The mapping rows of a load configuration, in order.

    Path-level settings are defaults, an entry's settings override them and stay for the entries
    after it (F3). Path-level steps run first, then the entry's own, each once (F5). A broken
    configuration stops the run (F4).
    """
    rows: list[MappingRow] = []
    for block in yaml.safe_load(text) or []:
        enabled = block.get("enabled", True)
        if not enabled:
            continue
        sticky = {k: block.get(k, v) for k, v in STICKY.items()}
        inherited = {k: block.get(k, v) for k, v in INHERITED.items()}
        for entry in block["mapping"]:
            if not entry.get("enabled", enabled):
                continue
            sticky |= {k: entry[k] for k in STICKY if k in entry}
            own = inherited | {k: entry[k] for k in INHERITED if k in entry}
            rows.append(
                MappingRow(
                    order=len(rows),
                    path=str(block["path"]),
                    project_name=block["project_name"],
                    file_regex=java_regex(entry["file_regex"]),
                    file_type=entry["file_type"],
                    steps=tuple(_steps(block.get("process_logic")) + _steps(entry.get("process_logic"))),
                    settings={
                        **sticky, **own, "limit_rows": _row_limit(own["limit_rows"]),
                        **{k: entry.get(k) for k in OWN},
                        "extract_file_name_data": block.get("extract_file_name_data"),
                        "format_extracted_date": block.get("format_extracted_date"),
                        "convert_table_name_snake_case": block.get("convert_table_name_snake_case", False),
                        "reset_failed": block.get("reset_failed", False),
                    },
                )
            )
    return rows


def _leaves(scope: Mapping[str, Any]) -> dict[str, str]:
    """Every scalar of a nested mapping under its own key; the first one of a name counts."""
    found: dict[str, str] = {}
    for key, value in scope.items():
        if isinstance(value, Mapping):
            for k, v in _leaves(value).items():
                found.setdefault(k, v)
        elif not isinstance(value, list):
            found.setdefault(key, str(value))
    return found


def fill_templates(value: Any, scope: Mapping[str, Any]) -> Any:
    """``{{key}}`` in every text of a nested value, by the scalars of the scope. An item of a
    list that is a mapping is filled from itself first."""
    if isinstance(value, str):
        for key, text in _leaves(scope).items():
            value = value.replace("{{" + key + "}}", text)
        return value
    if isinstance(value, list):
        return [
            fill_templates(fill_templates(v, v) if isinstance(v, Mapping) else v, scope) for v in value
        ]
    if isinstance(value, Mapping):
        return {k: fill_templates(v, scope) for k, v in value.items()}
    return value


def read_publish(text: str) -> list[dict[str, Any]]:
    """The items of a publish configuration with their templates filled."""
    return [fill_templates(item, item) for item in yaml.safe_load(text) or []]


# Statements that only a database server knows; they are skipped with a warning (M7).
SERVER_ONLY = re.compile(r"(?is)^\s*(vacuum|grant|revoke|create\s+role|alter\s+table\s+\S+\s+owner)\b")
IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*\Z")


def bind_sql(sql: str, schema: str | None, table: str | None, columns: list[str] | None) -> str | None:
    """A configured statement with its names put in and ``{file_id}`` as a parameter;
    None for statements a database server alone understands. Names must be plain identifiers."""
    if SERVER_ONLY.match(sql):
        return None
    for name in [n for n in (schema, table, *(columns or [])) if n is not None]:
        if not IDENTIFIER.match(name):
            raise ValueError(f"not an identifier: {name}")
    for key, text in (("{schema_name}", schema), ("{table_name}", table), ("{column_list}", ",".join(columns or []))):
        sql = sql.replace(key, text or "")
    sql = re.sub(r"(?is)^(\s*truncate\s+table\s+\S+)\s+cascade\b", r"\1", sql)
    return sql.replace("'{file_id}'", ":file_id").replace("{file_id}", ":file_id")


# What makes a statement's result over several files differ from that of one file at a time.
WHOLE_SET = re.compile(
    r"(?is)\b(or|limit|offset|distinct|group\s+by|having|over|union|except|intersect|exists|"
    r"count|sum|avg|min|max|first|last|any_value|collect_list|collect_set|row_number|rank|lead|lag|current_timestamp|now|rand|uuid)\b"
)
FILE_EQUALS = re.compile(r"(?is)\b(where|and|on)(\s+\(*\s*)((?:`[^`]+`|\w+)(?:\.(?:`[^`]+`|\w+))?)\s*=\s*:file_id\b")


def over_files(sql: str, ids: str) -> tuple[str | None, str]:
    """M7: a bound statement for one file as one for all files of the view ``ids`` (column file_id),
    or None and why it must run file by file.

    Every mention of the file must be a condition that a column equals it, and nothing in the
    statement may look at the rows of a file as a whole: then the rows it takes for all files are
    those it takes for each.
    """
    met = FILE_EQUALS.findall(sql)
    if len(met) != len(re.findall(r":file_id\b", sql)):
        return None, "the file is named outside a condition that a column equals it"
    whole = WHOLE_SET.search(sql)
    if whole:
        return None, f"'{whole[1]}' depends on all rows of a file"
    if not re.match(r"(?is)\s*(insert\s+into|delete|update|merge)\b", sql):
        return None, "only insert, delete, update and merge work on sets of files"
    return FILE_EQUALS.sub(rf"\1\2\3 IN (SELECT file_id FROM {ids})", sql), ""


# What is another value each time a statement runs, or hangs on the order of the rows it meets.
VARYING = re.compile(
    r"(?is)\b(limit|offset|tablesample|first|first_value|last|last_value|nth_value|any_value|collect_list|collect_set|"
    r"array_agg|listagg|string_agg|mode|now|rand|randn|random|uniform|randstr|uuid|shuffle|monotonically_increasing_id|"
    r"current_\w+|curdate|localtimestamp|unix_timestamp)\b"
)
INSERT = re.compile(
    r"(?is)\s*(insert\s+into\s+(?:table\s+)?([\w.`]+)(?:\s*\(\s*[\w`]+(?:\s*,\s*[\w`]+)*\s*\))?)\s+(select\b.*?)[;\s]*\Z")
BY_PLACE = re.compile(r"(?is)\bby\b[^()]*?(?<!\w)\d")
QUOTED = re.compile(r"(?s)'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|--[^\n]*|/\*.*?\*/")


def each_file(sql: str, ids: str) -> tuple[str, str, str] | None:
    """M7: a bound insertion of a query for one file, as the target, the insertion and the query that
    gives what it gives for each file of the view ``ids`` (column ``ids``) on its own: a lateral join.
    None for other statements, and where a query gives other rows each time it runs.

    Spark takes no value from outside beside an aggregate, so columns that are the file's id alone are
    taken from the view instead of from the query.
    """
    found = INSERT.match(sql)
    if not found or VARYING.search(QUOTED.sub("''", sql)) or any(":file_id" in q for q in QUOTED.findall(sql)):
        return None
    columns, rest = _select_list(found[3])
    own = [re.fullmatch(r"(?is)\s*:file_id(?:\s+(?:as\s+)?([a-z_]\w*))?\s*", c) for c in columns]
    used = QUOTED.sub("''", found[3])
    if any(own) and (BY_PLACE.search(used) or any(
            m and m[1] and len(re.findall(rf"(?i)\b{m[1]}\b", used)) > 1 for m in own)):
        return None
    inner = [c for c, m in zip(columns, own) if not m] or [" 1"]
    body = re.sub(r":file_id\b", f"{ids}.{ids}", "SELECT" + ",".join(inner) + rest)
    names = iter(range(len(inner)))
    outer = ", ".join(f"{ids}.{ids}" if m else f"_rows.c{next(names)}" for m in own) if any(own) else "_rows.*"
    named = "(" + ", ".join(f"c{n}" for n in range(len(inner))) + ")" if any(own) else ""
    return found[2], found[1], f"SELECT {outer} FROM {ids} JOIN LATERAL (\n{body}\n) AS _rows{named}"


def _select_list(query: str) -> tuple[list[str], str]:
    """The columns of a query that begins with SELECT, and what follows them."""
    plain = QUOTED.sub(lambda m: "_" * len(m[0]), query)
    depth, start, columns = 0, len("select"), []
    for m in re.finditer(r"(?i)[(),]|\bfrom\b", plain):
        depth += {"(": 1, ")": -1}.get(m[0], 0)
        if depth == 0 and m[0] not in "()":
            columns.append(query[start:m.start()])
            if m[0] != ",":
                return columns, " " + query[m.start():]
            start = m.end()
    return [*columns, query[start:]], ""
