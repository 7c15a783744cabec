"""Text expressions (X1–X13): all built-in Catalyst expressions, no UDF.

Every helper takes and returns a ``Column`` so it composes inside one
``select`` and stays inside whole-stage codegen.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._col import as_col

# --- fixed values: letters and signs that "latin-ascii" folds but Unicode does not decompose ---
FOLD_LETTERS = {"Ø": "O", "ø": "o", "Ð": "D", "ð": "d", "ª": "a", "º": "o", "Đ": "D", "đ": "d", "Ħ": "H", "ħ": "h", "ı": "i", "ĸ": "q",
                "Ł": "L", "ł": "l", "Ŋ": "N", "ŋ": "n", "ſ": "s", "Ŧ": "T", "ŧ": "t", "ƒ": "f", "‐": "-", "‑": "-", "‒": "-", "–": "-",
                "—": "-", "―": "-", "‘": "'", "’": "'", "‚": ",", "‛": "'", "“": '"', "”": '"', "‟": '"', "′": "'", "″": '"', "−": "-"}
# Those that expand to two or more characters.
FOLD_MULTI = (("ß", "ss"), ("Æ", "AE"), ("æ", "ae"), ("Œ", "OE"), ("œ", "oe"), ("Þ", "TH"), ("þ", "th"), ("ŉ", "'n"), ("Ĳ", "IJ"),
              ("ĳ", "ij"), ("…", "..."), ("„", ",,"), ("«", "<<"), ("»", ">>"))
# Blocks of accented Latin letters: Latin-1, Extended-A, Extended-B, Extended Additional.
FOLD_BLOCKS = ((0x00C0, 0x00FF), (0x0100, 0x017F), (0x0180, 0x024F), (0x1E00, 0x1EFF))
# --- end of fixed values ---


def _fold_table() -> tuple[str, str]:
    """(from, to), one letter each: a letter of the blocks whose decomposition is an ASCII letter and accents folds to it."""
    table = dict(FOLD_LETTERS)
    for first, last in FOLD_BLOCKS:
        for code in range(first, last + 1):
            base, *marks = unicodedata.normalize("NFD", chr(code))
            if marks and base.isascii() and all(unicodedata.combining(m) for m in marks):
                table[chr(code)] = base
    return "".join(table), "".join(table.values())


FOLD_FROM, FOLD_TO = _fold_table()
_MULTI = f"[{''.join(src for src, _ in FOLD_MULTI)}]"


def fold_accents(c) -> Column:
    """Transliterate Latin letters and typographic signs to ASCII.

    One ``translate`` by code point covers every precomposed letter; accents
    that stand as characters of their own after a Latin letter or digit go.
    Expansions and loose accents are looked for first, as most texts have none."""
    out = F.translate(as_col(c), FOLD_FROM, FOLD_TO)
    wide = out
    for src, dst in FOLD_MULTI:
        wide = F.replace(wide, F.lit(src), F.lit(dst))
    out = F.when(out.rlike(_MULTI), wide).otherwise(out)
    return F.when(out.rlike(r"\p{Mn}"), F.regexp_replace(out, r"([\p{IsLatin}0-9])\p{Mn}+", "$1")).otherwise(out)


def fold_accents_sql(expr: str) -> str:
    """Folding in SQL on its own terms, for oracle queries: the engine strips accents by decomposition, and only what
    does not decompose is replaced."""
    out = expr
    for src, dst in (*FOLD_LETTERS.items(), *FOLD_MULTI):
        out = "replace({}, '{}', '{}')".format(out, src, dst.replace("'", "''"))
    return f"strip_accents({out})"


def fold_lower(c) -> Column:
    """X1 + X2: the reference's standard text cleaning (fold, then lower)."""
    return F.lower(fold_accents(c))


def pad_left(c, width: int, fill: str = "0") -> Column:
    """Left pad like ``str_pad`` — never truncates longer values.

    Spark's ``lpad`` truncates (``lpad('1234567', 5, '0') = '12345'``)."""
    col = as_col(c)
    return F.when(F.length(col) >= width, col).otherwise(F.lpad(col, width, fill))


def pad_left_digits(c, width: int, fill: str = "0") -> Column:
    """X3 guarded: pad only all-digit values (codes such as state letters stay)."""
    col = as_col(c)
    return F.when(col.rlike("^[0-9]+$"), pad_left(col, width, fill)).otherwise(col)


def head(c, n: int) -> Column:
    """First ``n`` characters."""
    return F.substring(as_col(c), 1, n)


def tail(c, n: int) -> Column:
    """Last ``n`` characters (``str_sub(x, -n, -1)``)."""
    return F.right(as_col(c), F.lit(n))


def paste0(*parts, na_text: str | None = None) -> Column:
    """Concatenate.  ``na_text=None`` propagates NULL (SQL rule);
    ``na_text='NA'`` reproduces R's ``paste0`` which prints missing values."""
    cols = [as_col(p) if not isinstance(p, str) or p.startswith("`") else F.lit(p) for p in parts]
    if na_text is not None:
        cols = [F.coalesce(x.cast("string"), F.lit(na_text)) for x in cols]
    return F.concat(*cols)


def replace_all(c, pattern: str, replacement: str) -> Column:
    """Regex replace every match."""
    return F.regexp_replace(as_col(c), pattern, replacement)


def replace_first(c, pattern: str, replacement: str) -> Column:
    """Regex replace the first match only (lazy prefix captured as group 1)."""
    return F.regexp_replace(as_col(c), f"^((?s).*?)(?:{pattern})", "$1" + replacement)


def detect(c, pattern: str) -> Column:
    """Regex detect (NULL input → NULL, dropped by a filter)."""
    return as_col(c).rlike(pattern)


def detect_word(text, word, match: str = "word") -> Column:
    """Is ``word`` (a column) present in ``text`` (a column)?

    ``match='word'`` reproduces ``str_detect(text, paste0('\\\\b', word, '\\\\b'))``
    (so ``pt`` also matches inside ``pt do b``); ``match='token'`` tests
    membership of the ``/``-separated list instead."""
    t, w = as_col(text), as_col(word)
    if match == "word":
        return F.regexp(t, F.concat(F.lit("\\b"), w, F.lit("\\b")))
    if match == "token":
        return F.array_contains(F.transform(F.split(t, "/"), lambda x: F.trim(x)), w)
    raise ValueError(match)


def count_matches(c, pattern: str) -> Column:
    """Number of regex matches."""
    return F.regexp_count(as_col(c), F.lit(pattern))


def n_chars(c) -> Column:
    """Character length."""
    return F.length(as_col(c))


def list_length(c, sep: str = "/") -> Column:
    """Element count of a split; R's ``length(NA)`` is 1, so NULL → 1."""
    return F.coalesce(F.size(F.split(as_col(c), sep)), F.lit(1))


def repeat_text(s: str, n: int) -> Column:
    """Repeated string (``str_dup``)."""
    return F.repeat(F.lit(s), n)


def normalise_name(name: str) -> str:
    """S11 header normalisation, applied to column *names* at plan time, in
    the reference's order: strip double quotes, lower, make the name
    syntactic (characters other than letters, digits, ``.`` and ``_`` become
    ``.``; a leading digit or ``_`` gets an ``X`` prefix), ``.`` → ``_``,
    one left-to-right pass of ``__`` → ``_`` (so ``___`` leaves ``__`` and a
    trailing ``_`` stays), then accents folded."""
    import unicodedata

    n = name.replace('"', "").lower()
    n = "".join(ch if (ch.isalnum() or ch in "._") else "." for ch in n)
    if not n or not (n[0].isalpha() or (n[0] == "." and not n[1:2].isdigit())):
        n = "X" + n
    n = n.replace(".", "_").replace("__", "_")
    return "".join(ch for ch in unicodedata.normalize("NFKD", n) if not unicodedata.combining(ch))
