"""DuckDB (RE2) spellings of the text functions, for the oracle SQL.

Each helper mirrors the Spark ``Column`` function of the same name in
``wryspark.functions`` and returns a SQL expression string.
"""

from __future__ import annotations

from ..functions import regex as rx
from ..functions.wordlists import ENGLISH_STOPWORDS

END = "(" + rx.SPACE + r"|\z)"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def rr(x: str, pattern: str, repl: str) -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(repl)}, 'g')"


def str_list(words) -> str:
    return "[" + ", ".join(q(w) for w in words) + "]"


STOP = str_list(ENGLISH_STOPWORDS)


def clean(x: str) -> str:
    t = f"lower({x})"
    t = rr(t, rx.URL, "")
    t = rr(t, rx.DIGIT, "")
    return rr(t, rx.NON_WORD_NON_SPACE, "")


def letters_only(x: str) -> str:
    return f"lower({rr(x, '[^a-zA-Z]', ' ')})"


def ws_tokens(x: str) -> str:
    return f"list_filter(string_split_regex({x}, {q(rx.SPACE + '+')}), lambda w: w <> '')"


def treebank_spaced(x: str) -> str:
    t = rr(x, r"\.{2,}", r" \0 ")
    t = rr(t, r"\." + END, r" .\1")
    t = rr(t, r"([^\p{L}\p{N}_ \t\n\x0B\f\r.'/-])", r" \1 ")
    t = rr(t, r"(?i)n't" + END, r" n't\1")
    t = rr(t, r"(?i)'(s|re|ve|ll|d|m)" + END, r" '\1\2")
    return rr(t, "'" + END, r" '\1")


def word_tokens(x: str) -> str:
    return ws_tokens(treebank_spaced(x))


def alpha_tokens(x: str) -> str:
    return f"list_filter({word_tokens(x)}, lambda w: regexp_matches(w, {q(rx.ALPHA_TOKEN)}))"


def filtered_tokens(x: str) -> str:
    lowered = f"list_transform({alpha_tokens(x)}, lambda w: lower(w))"
    return f"list_filter({lowered}, lambda w: NOT list_contains({STOP}, w))"


def drop_stopwords_text(x: str, case_sensitive: bool = True) -> str:
    test = "w" if case_sensitive else "lower(w)"
    return (f"array_to_string(list_filter({ws_tokens(x)}, "
            f"lambda w: NOT list_contains({STOP}, {test})), ' ')")


def word_count(x: str) -> str:
    return f"CAST(len({ws_tokens(x)}) AS BIGINT)"


def char_count(x: str) -> str:
    return f"CAST(length({x}) AS BIGINT)"


def char_occurrences(x: str, ch: str) -> str:
    return f"CAST(length({x}) - length(replace({x}, {q(ch)}, '')) AS BIGINT)"


def ascii_punct_count(x: str) -> str:
    return f"CAST(length({rr(x, rx.NOT_ASCII_PUNCT, '')}) AS BIGINT)"


def nonword_count(x: str) -> str:
    return f"CAST(length({x}) - length({rr(x, rx.NON_WORD_NON_SPACE, '')}) AS BIGINT)"


def multi_punct_count(x: str) -> str:
    return f"CAST(len(regexp_extract_all({x}, {q(rx.MULTI_PUNCT)})) AS BIGINT)"


def large_number_flag(x: str) -> str:
    return f"CAST(CASE WHEN regexp_matches({x}, {q(rx.LARGE_NUMBER)}) THEN 1 ELSE 0 END AS BIGINT)"


def all_caps_count(x: str) -> str:
    return (f"CAST(len(list_filter({ws_tokens(x)}, lambda w: length(w) > 1 AND upper(w) = w "
            f"AND lower(w) <> w)) AS BIGINT)")


def avg_word_length(x: str) -> str:
    toks = ws_tokens(x)
    return (f"CASE WHEN len({toks}) > 0 THEN "
            f"CAST(list_sum(list_transform({toks}, lambda w: length(w))) AS DOUBLE) / len({toks}) END")


FEATURES = {
    "word_count": word_count,
    "char_count": char_count,
    "headline_length": char_count,
    "exclamation_mark": lambda x: char_occurrences(x, "!"),
    "question_mark": lambda x: char_occurrences(x, "?"),
    "ascii_punct_count": ascii_punct_count,
    "punctuation_count": nonword_count,
    "multiple_punct_count": multi_punct_count,
    "large_number_flag": large_number_flag,
    "all_caps_count": all_caps_count,
    "avg_word_length": avg_word_length,
}

# Reusable CTEs of the data binding.
HEADLINES = """h AS (
  SELECT d.doc_id AS row_id, d.text AS headline, CAST(l.toxic AS INTEGER) AS is_sarcastic
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
v1 AS (SELECT * FROM h WHERE row_id % 2 = 0 AND headline IS NOT NULL AND is_sarcastic IS NOT NULL),
v2 AS (SELECT * FROM h WHERE row_id % 2 = 1 AND headline IS NOT NULL AND is_sarcastic IS NOT NULL),
merged AS (
  SELECT row_id, headline, is_sarcastic, 1 AS version FROM v1
  UNION ALL
  SELECT row_id, headline, is_sarcastic, 2 AS version FROM v2
  WHERE NOT EXISTS (SELECT 1 FROM v1 WHERE v1.headline = v2.headline))"""


def strip(x: str) -> str:
    return rr(x, "^" + rx.SPACE + "+|" + rx.SPACE + "+$", "")


def sentences(x: str) -> str:
    from ..functions.text import SENTENCE_ABBREVIATIONS
    t = strip(x)
    t = f"regexp_replace({t}, {q(chr(40) + '[.!?][' + chr(34) + chr(39) + ')' + chr(92) + ']]*)' + rx.SPACE + '+')}, '\\1' || chr(1), 'g')"
    abbr = "|".join(a.replace(".", r"\.") for a in SENTENCE_ABBREVIATIONS)
    t = (f"regexp_replace({t}, {q('(^|[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}_])(' + abbr + ')' + chr(92) + '.' + chr(92) + 'x01')}, "
         f"'\\1\\2. ', 'g')")
    return f"list_filter(list_transform(string_split({t}, chr(1)), lambda s: {strip('s')}), lambda s: s <> '')"


def lead_sentence(x: str) -> str:
    return f"coalesce(({sentences(x)})[1], '')"


def rouge_tokens(x: str) -> str:
    return f"regexp_extract_all(lower(coalesce({x}, '')), {q(rx.ROUGE_TOKEN)})"
