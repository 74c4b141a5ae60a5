"""Regex classes shared by Spark (Java regex) and the DuckDB oracle (RE2).

Spelled so both engines read them the same way: Spark's plain ``\\w`` is
ASCII-only, ``\\b`` has engine-specific Unicode meaning, and RE2 has no
look-around, so none of those are used.
"""

# Character classes.
WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]"
SPACE = r"[ \t\n\x0B\f\r]"
NOT_SPACE = r"[^ \t\n\x0B\f\r]"
NON_WORD_NON_SPACE = r"[^\p{L}\p{N}_ \t\n\x0B\f\r]"
DIGIT = r"\p{Nd}"
# The 32 ASCII punctuation marks, as ranges: ! to /, : to @, [ to `, { to ~.
ASCII_PUNCT = r"[!-/:-@\[-`{-~]"
NOT_ASCII_PUNCT = r"[^!-/:-@\[-`{-~]"
URL = r"http" + NOT_SPACE + "+"
MULTI_PUNCT = r"[?!.]{2,}"
LARGE_NUMBER = r"(^|" + NOT_WORD + r")\p{Nd}{5,}($|" + NOT_WORD + ")"
ALPHA_TOKEN = r"^\p{L}+$"
ROUGE_TOKEN = r"[a-z0-9]+"
