"""Column expressions for text: the tokenizer and the doc-id parser.

All of them are built-in Spark expressions, so they run inside whole-stage
codegen on the executors; nothing here goes through Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A token is a maximal run of ASCII letters and digits,
# lower-cased; every other character (punctuation, '_', every non-ASCII
# character) separates tokens.
_TOKEN = r"[A-Za-z0-9]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def token_text(text: Column | str) -> Column:
    """The tokens of ``text``, joined by blanks.

    Tokens are extracted first and lower-cased second: once extracted they
    are pure ASCII, so one ``lower`` over the blank-joined tokens is exact
    (lower-casing the raw text could turn a non-ASCII letter such as ``İ``
    into an ASCII ``i``). A single regex pass, no lambda.
    """
    return F.lower(F.array_join(F.regexp_extract_all(_col(text), F.lit(_TOKEN), 0), " "))


def tokenize(text: Column | str) -> Column:
    """ARRAY<STRING> of the tokens of ``text``, in text order, repeats kept;
    ``array_remove`` turns the ``[""]`` of a token-free text into ``[]``."""
    return F.array_remove(F.split(token_text(text), " "), "")


def token_count(text: Column | str) -> Column:
    """Number of tokens in ``text`` as BIGINT (zero for an empty or NULL
    passage); counting needs no lower-casing."""
    # greatest() skips NULL and lifts the legacy size(NULL) = -1 to 0
    return F.greatest(F.size(F.regexp_extract_all(_col(text), F.lit(_TOKEN), 0)), F.lit(0)).cast("bigint")


def parse_doc_id(raw: Column | str) -> Column:
    """Leading integer of ``raw`` as BIGINT, NULL if there is none.

    Accepts leading blanks, a sign and trailing junk (``' 8'`` → 8,
    ``'7abc'`` → 7), the way a C ``stoi`` reads a doc id; a string without a
    leading number gives NULL so the caller can reject the line.
    """
    digits = F.regexp_extract(_col(raw), r"^\s*([+-]?[0-9]+)", 1)
    return F.nullif(digits, F.lit("")).try_cast("bigint")
