"""SQL (DuckDB/RE2) spellings of the text rules in ``reviewlab.functions.text``."""

from reviewlab.functions.text import HELPFUL_MARKER, PUNCTUATION

_P = PUNCTUATION.replace("\n", "").replace("\t", "")
PUNCT_SQL = "'" + _P.replace("'", "''") + "' || chr(10) || chr(9)"
WS_SQL = (r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}"
          r"\x{202F}\x{205F}\x{3000}]")
NON_WS_SQL = "[^" + WS_SQL[1:]


def clean_text_sql(c: str) -> str:
    return f"translate(lower({c}), {PUNCT_SQL}, '')"


def clean_review_sql(c: str) -> str:
    return (f"translate(trim(regexp_replace(replace(lower({c}), '039', ''''), '{WS_SQL}+', ' ', 'g')), "
            f"{PUNCT_SQL}, '')")


def word_count_sql(c: str) -> str:
    return f"CAST(CASE WHEN {c} IS NULL THEN 1 ELSE len(regexp_extract_all({c}, '{NON_WS_SQL}+')) END AS INTEGER)"


def tokens_sql(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, '{WS_SQL}+'), lambda w: w <> '')"


def upper_count_sql(c: str) -> str:
    return (f"CAST(CASE WHEN {c} IS NULL THEN 0 ELSE len(list_filter({tokens_sql(c)}, "
            f"lambda w: w = upper(w) AND w <> lower(w))) END AS INTEGER)")


def marker_null_sql(c: str) -> str:
    return f"CASE WHEN coalesce(contains({c}, '{HELPFUL_MARKER}'), false) THEN NULL ELSE {c} END"
