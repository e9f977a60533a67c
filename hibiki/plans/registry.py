"""Registration of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# White space in RE2's notation, equal to functions.text.WS.
WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def query(sql: str | None = None):
    """Register a query under its function's name, with the SQL that must give the same rows."""

    def wrap(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return wrap


def squeezed(x: str) -> str:
    return f"regexp_replace({x}, '{WS}+', '', 'g')"


def visible(x: str) -> str:
    return f"length({squeezed(x)})"


def trimmed(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def count_of(x: str, needle: str) -> str:
    n = needle.replace("'", "''")
    return f"((length({x}) - length(replace({x}, '{n}', ''))) // {len(needle)})"


def kind(x: str) -> str:
    t = trimmed(x)
    return f"CASE WHEN coalesce({t}, '') = '' THEN 'blank' WHEN left({t}, 1) IN ('「', '『', '“', '\"') THEN 'dialogue' ELSE 'narration' END"


PARAS = "para AS (SELECT DISTINCT para_id, part_id, side, para_index, kind, text FROM paragraphs)"
ENTRIES = "entry AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY file_pos DESC) rn FROM toc) WHERE rn = 1)"
COUNTS = (
    PARAS
    + f", cnt AS (SELECT part_id, side, count(*) FILTER ({kind('text')} <> 'blank') AS n_paragraphs, coalesce(sum({visible('text')}), 0)::BIGINT AS chars"
    + " FROM para WHERE part_id IS NOT NULL GROUP BY ALL)"
)
