"""String, code and path scalar functions (Column -> Column).

Built-in expressions only (regex, substring, higher-order array functions).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions._util import as_col

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's for equal results.
# Exact deny list of model codes (literals; "%" and "*" are not wildcards):
MODEL_CODE_DENY = [
    "Y", "Y1W", "Y2", "Y50", "Y50M1", "Y51", "Y8", "Y6K14", "Y6K14BBC", "Y6K14BBD",
    "YB1", "YC%", "YCG", "YE2", "YL*", "YLA51C2C", "YM1", "YM125", "YN4", "YN411",
    "YN4B2", "YN4B2C2B", "YN4B2C2C", "YN4B2C2D", "YN4D2C2B", "YN4D2C2C", "YN4D2C2D",
    "YR4BED", "YR4CSH", "YR4BEP", "YS", "Y1E19", "Y3A", "Y3AM", "Y3AM1", "Y3AS1",
    "Y5A", "Y5AF9", "Y5AF9BAA", "Y5AF9BAB", "Y5AF9BAC", "YP7R0", "YXXXX",
]
# Deny list of 3-character base model codes:
BASE_CODE_DENY = [
    "Y1W", "Y50", "Y51", "Y6K", "YB1", "YCG", "YE2", "YLA", "YM1", "YN4", "YR4",
    "Y1E", "Y5A", "Y3A", "YXX", "YP7",
]
# Required model-code prefix:
MODEL_CODE_PREFIX = "Y"
# Location codes folded into one location, and the location they become:
LOCATION_ALIASES = ["MUL", "MULG", "MULM", "SPIL", "TMP"]
LOCATION_TARGET = "MSIL"
# Plant groups: control point starting with a letter, otherwise:
PLANT_GROUP_LETTER = "SMG"
PLANT_GROUP_OTHER = "MSIL"
# Department-text prefixes for defect responsibility:
DESIGN_PREFIXES = ["en", "yo"]
VENDOR_PREFIXES = ["qa"]
RESP_DESIGN, RESP_VENDOR, RESP_PRODUCTION = "DESIGN", "VENDOR", "PRODUCTION"
# Default engine type per engine prefix (used when no word in the model
# description starts with the prefix); a null prefix becomes "XXX":
ENGINE_DEFAULTS = {
    "D13": "D13A", "D16": "D16", "E08": "E08", "E15": "E15A", "F8B": "F8B",
    "F8D": "F8D", "F10": "F10", "G12": "G12B", "G13": "G13", "K10": "K10B",
    "K12": "K12M", "K14": "K14B", "K15": "K15B", "G16": "G16", "M15": "M15A",
    "G10": "G10", "M16": "M16", "XXX": "XXX",
}
ENGINE_NULL_PREFIX = "XXX"
# UUID pattern (8-4-4-4-12 lower-case hex):
UUID_PATTERN = r"[a-f0-9]{8}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{12}"
# Link pattern removed by the social-text clean-up:
LINK_PATTERN = r"(http?\://|https?\://|www)\S+"
# Emoji ranges removed by the social-text clean-up (our choice of ranges):
EMOJI_CLASS = r"[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}\x{FE0F}\x{200D}]"
# Default stop words for the social-text clean-up (a parameter; ours):
DEFAULT_STOP_WORDS = [
    "the", "and", "for", "are", "but", "not", "you", "all", "any", "can", "had",
    "her", "was", "one", "our", "out", "has", "his", "how", "its", "may", "new",
    "now", "see", "who", "did", "get", "let", "she", "too", "use", "that", "with",
    "this", "from", "they", "have", "were", "been", "will", "would", "there",
    "their", "what", "about", "which", "when", "your", "than", "then", "them",
    "into", "just", "also", "very",
]
# ---------------------------------------------------------------------------

WORD_CHAR = r"[\p{L}\p{N}_]"


def prefix(c, n: int) -> Column:
    """First ``n`` characters."""
    return F.substring(as_col(c), 1, n)


def remove_dash(c) -> Column:
    """Drop a dash standing at position 6; any other dash stays."""
    x = as_col(c)
    return F.when(F.substring(x, 6, 1) == "-",
                  F.concat(F.substring(x, 1, 5), x.substr(F.lit(7), F.length(x)))) \
        .otherwise(x)


def digits(c) -> Column:
    """Digits of the text read as an integer; no digits (or null) -> 0."""
    kept = F.regexp_replace(as_col(c).cast("string"), r"[^0-9]", "")
    return F.coalesce(kept.try_cast("bigint"), F.lit(0).cast("bigint"))


def responsibility(c) -> Column:
    """Department text -> DESIGN / VENDOR / PRODUCTION (null -> PRODUCTION)."""
    t = F.lower(F.trim(as_col(c)))
    design = None
    for p in DESIGN_PREFIXES:
        cond = t.startswith(p)
        design = cond if design is None else (design | cond)
    vendor = None
    for p in VENDOR_PREFIXES:
        cond = t.startswith(p)
        vendor = cond if vendor is None else (vendor | cond)
    return (F.when(t.isNull(), F.lit(RESP_PRODUCTION))
            .when(design, F.lit(RESP_DESIGN))
            .when(vendor, F.lit(RESP_VENDOR))
            .otherwise(F.lit(RESP_PRODUCTION)))


def alnum_key(c) -> Column:
    """Keep Unicode letters and digits only."""
    return F.regexp_replace(as_col(c), r"[^\p{L}\p{N}]", "")


def location(c, aliases=LOCATION_ALIASES, target=LOCATION_TARGET) -> Column:
    """Location from a control number: 4 chars, dashes dropped, aliases folded."""
    loc = F.replace(F.substring(as_col(c), 1, 4), F.lit("-"), F.lit(""))
    return F.when(loc.isin(list(aliases)), F.lit(target)).otherwise(loc)


def plant_group(c, letter=PLANT_GROUP_LETTER, other=PLANT_GROUP_OTHER) -> Column:
    """Group by first character: a letter -> ``letter`` group, else ``other``."""
    x = as_col(c)
    return F.when(x.isNull(), F.lit(None).cast("string")) \
        .when(x.rlike(r"^\p{L}"), F.lit(letter)).otherwise(F.lit(other))


def engine_type(prefix_col, text_col, defaults: dict | None = None) -> Column:
    """First word after whitespace that starts with the prefix, else the
    default for the prefix; a null prefix is treated as ``XXX``; an unknown
    prefix without a match gives null.
    """
    defaults = ENGINE_DEFAULTS if defaults is None else defaults
    p = F.coalesce(as_col(prefix_col), F.lit(ENGINE_NULL_PREFIX))
    pattern = F.concat(F.lit(r"\s("), p, F.lit(r"\w+)"))
    found = F.nullif(F.call_function("regexp_extract", as_col(text_col), pattern, F.lit(1)),
                     F.lit(""))
    default = F.lit(None).cast("string")
    if defaults:
        m = F.create_map(*[x for kv in defaults.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
        default = F.try_element_at(m, p)
    return F.coalesce(found, default)


def path_part(c, key: str) -> Column:
    """Hive partition value ``key=value`` from a path; absent -> null."""
    return F.nullif(F.regexp_extract(as_col(c), rf"{key}=([^/]*)", 1), F.lit(""))


def extract_uuid(c) -> Column:
    """First UUID in the text, else ``''``."""
    return F.regexp_extract(F.coalesce(as_col(c), F.lit("")), UUID_PATTERN, 0)


def split_keywords(c, sep: str = "/") -> Column:
    """Keyword text -> flat lower-case word list; ``sep`` is ``/`` or ``,``.

    Lower-case, drop spaces after the separator, split on it; a piece with one
    word stays whole (trimmed), a multi-word piece is split on whitespace.
    """
    x = F.regexp_replace(F.lower(as_col(c)), f"{sep} +", sep)
    pieces = F.split(x, sep, -1)
    words = F.transform(pieces, lambda p: F.filter(F.split(F.trim(p), r"\s+"),
                                                  lambda w: w != ""))
    return F.flatten(words)


def job_id(c) -> Column:
    """Step-job id: last two ``:`` parts of an execution id joined by ``-``."""
    parts = F.split(as_col(c), ":")
    start = F.greatest(F.size(parts) - 1, F.lit(1))
    return F.array_join(F.slice(parts, start, F.lit(2)), "-")


def join_text(*cols) -> Column:
    """Space-joined text of the given columns, skipping nulls."""
    return F.concat_ws(" ", *[as_col(c).cast("string") for c in cols])


def clean_columns_names(names) -> list[str]:
    """Snake-case column names (our rule: non-alnum runs -> ``_``, lower)."""
    import re
    out = []
    for n in names:
        s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", str(n))
        s = re.sub(r"[^0-9A-Za-z]+", "_", s).strip("_").lower()
        out.append(s)
    return out


def mention_count(c) -> Column:
    """Number of ``@word`` mentions not glued to a preceding word char."""
    return F.size(F.regexp_extract_all(F.coalesce(as_col(c), F.lit("")),
                                       F.lit(rf"(?<!{WORD_CHAR})@{WORD_CHAR}+"), F.lit(0)))


def hashtag_count(c) -> Column:
    """Number of ``#word`` hashtags not glued to a preceding word char."""
    return F.size(F.regexp_extract_all(F.coalesce(as_col(c), F.lit("")),
                                       F.lit(rf"(?<!{WORD_CHAR})#{WORD_CHAR}+"), F.lit(0)))


def clean_tokens(c, stop_words=None) -> Column:
    """Social clean-up as an array of tokens.

    Strip tags, the ``@`` of mentions, links, emoji and ``#``; ``_`` ->
    space; keep letter/digit runs; distinct (first occurrence); drop stop
    words (tested before lower-casing, as the source does) and tokens of
    two characters or less; lower-case.
    """
    stop = DEFAULT_STOP_WORDS if stop_words is None else list(stop_words)
    s = F.regexp_replace(as_col(c).cast("string"), r"<.*?>", "")
    s = F.regexp_replace(s, rf"(?<!{WORD_CHAR})@(?={WORD_CHAR})", "")
    s = F.regexp_replace(s, LINK_PATTERN, " ")
    s = F.regexp_replace(s, EMOJI_CLASS, "")
    s = F.replace(F.replace(s, F.lit("#"), F.lit("")), F.lit("_"), F.lit(" "))
    toks = F.array_distinct(F.regexp_extract_all(s, F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
    if stop:
        toks = F.array_except(toks, F.array(*[F.lit(w) for w in stop]))  # by hash, not a scan of the list for each token
    toks = F.filter(toks, lambda t: F.length(t) > 2)
    return F.transform(toks, lambda t: F.lower(t))


def clean_text(c, stop_words=None) -> Column:
    """:func:`clean_tokens` joined by single spaces."""
    return F.array_join(clean_tokens(c, stop_words), " ")


# --- byte-bounded trim ------------------------------------------------------

def _escaped_width(ch: str) -> int:
    o = ord(ch)
    if ch in "\\\n\t\r":
        return 2
    if o < 32 or o == 127:
        return 4
    if o < 128:
        return 1
    if o < 256:
        return 4
    if o < 65536:
        return 6
    return 10


def trim_escaped_py(text, size: int):
    """Reference rule for one value (tests hold :func:`trim_escaped` against it).

    Take the first ``size`` chars; when their escaped width reaches ``size``
    cut at ``size`` escaped bytes; a cut inside an escape drops the last
    (partial) word instead.
    """
    if text is None:
        return None
    trm = str(text)[:size]
    # the escaped width of the whole head, measured by the codec (fast path)
    if len(trm.encode("unicode_escape")) < size:
        return trm
    widths = [_escaped_width(ch) for ch in trm]
    total, k = 0, 0
    for w in widths:
        if total + w > size:
            break
        total += w
        k += 1
    if total == size or k == len(trm):
        return trm[:k]
    head = trm[:k]
    cut = head.rfind(" ")
    return head[:cut] if cut >= 0 else head


def trim_escaped(c, size: int) -> Column:
    """Byte-bounded trim (see :func:`trim_escaped_py`) in built-in functions:
    each of the first ``size`` characters gets as many NULs behind it as its escape is
    longer than one (its own NULs are gone by then); what stands behind ``size`` tells the cut."""
    head = F.substring(as_col(c), 1, size)
    laid = head
    for kind, width in ((r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\xFF]", 4), (r"[\\\n\t\r]", 2), (r"[\x{100}-\x{FFFF}]", 6), (r"[\x{10000}-\x{10FFFF}]", 10)):
        laid = F.regexp_replace(laid, kind, "a" + "\0" * (width - 1))

    def cut(marks):
        partial = F.substring(marks, size + 1, 1) == "\0"  # an escape begins within ``size`` and ends behind it
        whole = F.length(F.replace(F.substring(marks, 1, size), F.lit("\0"), F.lit(""))) - partial.cast("int")
        return F.struct(F.substring(head, F.lit(1), whole).alias("kept"), partial.alias("partial"))

    def word(found):
        kept = found["kept"]
        gap = F.instr(F.reverse(kept), " ")
        return F.when(~found["partial"] | (gap == 0), kept).otherwise(F.substring(kept, F.lit(1), F.length(kept) - gap))

    # each step bound to a name (a lambda's argument), so that it runs once a row
    slow = F.element_at(F.transform(F.transform(F.array(laid), cut), word), 1)
    simple = (F.length(head) == F.octet_length(head)) & head.rlike(r"^[ -\[\]-~]*\z")
    return F.when(head.isNull() | simple, head).otherwise(slow)


def concat_key(*cols, sep: str = "") -> Column:
    """Composite key by concatenation; null if any part is null (SQL rule)."""
    parts = []
    for i, c in enumerate(cols):
        if i and sep:
            parts.append(F.lit(sep))
        parts.append(as_col(c).cast("string"))
    return F.concat(*parts)


def model_label(name, domestic, variant) -> Column:
    """Label of a model: name, ``DOM`` or ``EXP``, and ``-N`` for the variant."""
    return F.concat(as_col(name), F.lit("-"), F.when(domestic, "DOM").otherwise("EXP"),
                    F.when(variant, "-N").otherwise(""))


def owner(resolved, fallback) -> Column:
    """The resolved owner, else the folder it was found in."""
    return F.coalesce(as_col(resolved), as_col(fallback))
