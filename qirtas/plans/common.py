"""Reading tables, and pieces of SQL that the queries' counterparts share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from qirtas.functions.metrics import NO_TEXT_REPLIES, SEEN_WORDS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register(queries: dict, oracles: dict, sql: str | None = None):
    def keep(query):
        queries[query.__name__] = query
        if sql:
            oracles[query.__name__] = sql
        return query

    return keep


def tok(t: str) -> str:
    return rf"list_filter(string_split_regex({t}, '\s+'), lambda x: x <> '')"


def strip(t: str) -> str:
    return rf"regexp_replace({t}, '^\s+|\s+$', '', 'g')"


def full_lines(t: str) -> str:
    return rf"list_filter(list_transform(string_split({t}, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '')"


def count(t: str, pattern: str) -> str:
    return f"len(regexp_extract_all({t}, '{pattern}'))"


def share(a: str, b: str) -> str:
    return f"(case when ({b}) > 0 then ({a})::double / ({b}) else 0.0 end)"


def reply(t: str) -> str:
    """Is it a reply that there is no text?"""
    n = rf"regexp_replace(trim(regexp_replace(lower({t}), '\s+', ' ', 'g')), '^[()\[\]{{}} .]+|[()\[\]{{}} .]+$', '', 'g')"
    n = n.replace("trim(", "regexp_replace(").replace(r"'\s+', ' ', 'g'))", r"'\s+', ' ', 'g'), '^ | $', '', 'g')")
    seen = " or ".join(f"contains(z, '{w}')" for w in SEEN_WORDS)
    starts = " or ".join("starts_with(z, '{}')".format(x.strip("()[]{} .").replace("'", "''")) for x in NO_TEXT_REPLIES)
    return f"list_transform([{n}], lambda z: z <> '' and (starts_with(z, 'scanned with') or contains(z, 'camscanner') or (contains(z, 'image') and contains(z, 'text') and ({seen})) or {starts}))[1]"


STATS = f"""s as (select *, len(w) as n, len(list_filter(w, lambda x: length(x) = 1)) as one,
  len(list_filter(w, lambda x: length(x) <= 2 and regexp_matches(x, '[0-9]'))) as frag from (select *, {tok('text')} as w from src))"""
RATIOS = f"n::bigint as token_count, round({share('one', 'n')}, 6) as single_char_ratio, round({share('frag', 'n')}, 6) as digit_fragment_ratio"
