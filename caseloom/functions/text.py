"""Text columns: search, repair, keys, clipping.

The functions are Column -> Column and stay inside the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom import fixed_values as fv

# Java regex flags that give the semantics the patterns were written for:
# Unicode classes (U), "." stopping at "\n" only (d), and case folding (i).
_FLAGS = "dU"

# The characters str.strip() removes.
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())

ZERO_WIDTH = "\u200b\u200c\u200d\ufeff"

#: Code pages that UTF-8 is mistaken for; earlier ones win where two explain a text equally well.
PAGES = ("cp1252", "latin-1", "cp1250")
LAYERS = 3  # how often a text may have been mistaken


def _upper_half(page: str) -> list[str]:
    """The characters of a page's bytes 80 to FF; the control character where a byte has none."""
    return [bytes([b]).decode(page, "ignore") or chr(b) for b in range(0x80, 0x100)]


def _class(chars: Sequence[str]) -> str:
    """The characters as the inside of a regex class, neighbouring ones as a range: Java tests the parts of a class in turn."""
    out, codes = "", sorted({ord(ch) for ch in chars})
    for k, first in enumerate(codes):
        if k and codes[k - 1] == first - 1:
            continue
        last = next((c for c, beyond in zip(codes[k:], codes[k + 1:]) if beyond != c + 1), codes[-1])
        out += f"\\x{{{first:x}}}" + (f"-\\x{{{last:x}}}" if last > first else "")
    return out


def _beyond_ascii(inside: str) -> str:
    """A class of characters from U+0080 on; plain ones fail its first test."""
    return f"[\\x80-\\x{{10ffff}}&&[{inside}]]"


_UPPER = {page: _upper_half(page) for page in PAGES}
_LEAD = _class([ch for upper in _UPPER.values() for ch in upper[0x42:0x75]])  # bytes C2 to F4 start a character
_FOLLOW = _class([ch for upper in _UPPER.values() for ch in upper[:0x40]])  # bytes 80 to BF go on with it
_SUSPECT = _beyond_ascii(_LEAD) + _beyond_ascii(_FOLLOW)
_CONTROL = "[\\x80-\\x9f]"


def search(c: Column, pattern: str, ignore_case: bool = True) -> Column:
    """Regex search with Unicode word classes; null in, null out."""
    return c.rlike(f"(?{'i' if ignore_case else ''}{_FLAGS}){pattern}")


def any_of(patterns: Sequence[str]) -> str:
    """One pattern for all; a word boundary they share is tested once per position."""
    def alternatives(p: str) -> bool:
        while (flat := re.sub(r"\([^()]*\)", "", p)) != p:
            p = flat
        return "|" in p

    if len(patterns) > 1 and all(p.startswith(r"\b") and not alternatives(p) for p in patterns):
        return r"\b(?:" + "|".join(p[2:] for p in patterns) + ")"
    return "|".join(patterns)


def matches_any(c: Column, patterns: Sequence[str], ignore_case: bool = True) -> Column:
    """True where any pattern is found; null text counts as no match."""
    return F.coalesce(search(c, any_of(patterns), ignore_case), F.lit(False))


def mentions_brand(c: Column, brand: str) -> Column:
    """Substring test for @brand, not a word match."""
    return search(c, "@" + re.escape(brand))


def flag_dm_redirect(c: Column, patterns: Sequence[str] = fv.DM_REDIRECT_PATTERNS) -> Column:
    return matches_any(c, patterns)


def no_dm_preference(c: Column, pattern: str = fv.NO_DM_PATTERN) -> Column:
    return matches_any(c, [pattern])


def strip(c: Column) -> Column:
    """str.strip(): Unicode whitespace off both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def _undone(c: Column, page: str) -> Column:
    """UTF-8 that was once decoded as the page, decoded anew.

    The text is cut into runs of characters the page can hold.  A run whose bytes
    are valid UTF-8 is decoded as such, any other run stays, so emoji or CJK next to
    a damaged word do not block its repair.
    """
    upper = _UPPER[page]
    moved = [(ch, chr(b)) for b, ch in enumerate(upper, 0x80) if ch != chr(b)]
    held, other = f"[\\x00-\\x7f[{_class(upper)}]]", _beyond_ascii(f"^{_class(upper)}")

    def decode(run: Column) -> Column:
        """Encode only behind the test: it raises on characters it cannot map."""
        one_byte = run
        if moved:  # a character at a time, so only where there is one to move
            there = run.rlike(_beyond_ascii(_class([a for a, _ in moved])))
            one_byte = F.when(there, F.translate(run, "".join(a for a, _ in moved), "".join(b for _, b in moved))).otherwise(run)
        raw = F.encode(one_byte, "ISO-8859-1").cast("string")
        return F.when((run != "") & ~run.rlike(other), F.coalesce(F.try_validate_utf8(raw), run))

    runs = F.regexp_extract_all(c, F.lit(f"{held}+|{other}+"), F.lit(0))
    by_run = F.array_join(F.transform(runs, lambda run: F.coalesce(decode(run), run)), "")
    return F.coalesce(decode(c), by_run)


def repair_mojibake(c: Column, pages: Sequence[str] = PAGES, layers: int = LAYERS) -> Column:
    """Undo UTF-8 text that was decoded as another code page, once or several times over.

    A search over pages and layers: of the text as it is and what each page makes of it,
    the most plausible goes on to the next layer, that with the fewest pairs of
    characters that look like the bytes of one, and control characters besides; the text as it is wins ties, so
    a sound text stays, and of two changed ones that with more bytes joined.  Texts without such a pair are not looked at further.
    """
    def layer(text: Column) -> Column:
        tried = F.array(text, *[_undone(text, page) for page in pages])
        ranked = F.transform(tried, lambda t, i: F.struct(  # every candidate is made once
            F.regexp_count(t, F.lit(f"{_SUSPECT}|{_CONTROL}")).alias("bad"), (i > 0).alias("changed"), F.length(t).alias("length"), i.alias("i"), t.alias("text")))
        return F.when(text.rlike(_SUSPECT), F.array_min(ranked)["text"]).otherwise(text)

    found = c
    for _ in range(layers):
        found = F.transform(F.array(found), layer)[0]  # each layer is computed once
    return F.when(~c.rlike(_SUSPECT), c).otherwise(found)


def straighten_quotes(c: Column) -> Column:
    return F.translate(c, "\u02bc\u2018\u2019\u201a\u201b\u201c\u201d\u201e\u201f", "'" * 5 + '"' * 4)


def unescape_entities(c: Column) -> Column:
    """The common HTML entities, in texts that are not markup themselves."""
    out = c
    for entity, char in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                         ("&nbsp;", "\xa0"), ("&amp;", "&")]:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.when(c.contains("&") & ~c.contains("<"), out).otherwise(c)


def plain_line_ends(c: Column) -> Column:
    return F.regexp_replace(c, "\\r\\n|[\\r\\x85\\u2028\\u2029]", "\n")


# The repair of a text column, step by step.
REPAIRS = (unescape_entities, repair_mojibake, lambda c: plain_line_ends(straighten_quotes(c)))


def clean_text(df: DataFrame, *cols: str) -> DataFrame:
    """Repair text columns: entities, encoding, quotes, line ends.

    Each step is a projection of its own, because the encoding repair reads
    its input several times and the input should be computed once.
    """
    for repair in REPAIRS:
        df = df.withColumns({c: repair(F.col(c)) for c in cols})
    return df


def reply_dedup_key(c: Column, strip_handles: bool = False) -> Column:
    """Case, spacing and links folded away, so only the wording remains."""
    key = F.regexp_replace(F.lower(c), r"(?U)\s+", " ")
    key = F.regexp_replace(key, r"(?U)https?://\S+", "<link>")
    return F.regexp_replace(key, r"(?U)\A\s*(@\w+\s+)+", "") if strip_handles else key


def strip_code_fence(c: Column) -> Column:
    """Drop a Markdown code fence around a model response."""
    body = F.regexp_replace(strip(c), r"\A```json", "")
    return strip(F.regexp_replace(F.regexp_replace(body, r"\A```", ""), r"```\z", ""))


def strip_invisible(c: Column) -> Column:
    return strip(F.translate(c, ZERO_WIDTH, ""))


def fallback_text(c: Column, text: str = fv.FAILED_REPLY) -> Column:
    """The placeholder where no reply came back (null or empty)."""
    return F.when(c.isNull() | (c == ""), F.lit(text)).otherwise(c)


def reply_is_malformed(c: Column, min_chars: int = fv.MIN_REPLY_CHARS) -> Column:
    """Missing, too short, or cut off before a closing mark or a link."""
    text = strip(c)
    clean_end = search(text, r'[.!?"\u2019]$', False) | search(text, r"https?://\S+$", False)
    return F.coalesce((F.length(text) < min_chars) | ~clean_end, F.lit(True))


def over_limit(c: Column, limit: int = fv.REPLY_LIMIT_CHARS) -> Column:
    return F.coalesce(F.length(c) > limit, F.lit(False))


def truncate_text(c: Column, n: int) -> Column:
    """The first n code points."""
    return F.substring(c, 1, n)


def precedent_summary(precedents: Column, n: int = fv.PRECEDENT_CLIP) -> Column:
    return F.array_join(
        F.transform(precedents, lambda p: truncate_text(p["customer_text"], n)), "; ")


def format_examples(blocks: Column) -> Column:
    """Text blocks separated by blank lines."""
    return F.array_join(blocks, "\n\n")


def numbered_prompt(texts: Column) -> Column:
    """'1. first' / '2. second' / ..."""
    return F.array_join(
        F.transform(texts, lambda t, i: F.concat((i + 1).cast("string"), F.lit(". "), F.coalesce(t, F.lit("")))), "\n")


def request_key(*parts: Column) -> Column:
    """Hash that identifies a model request by everything that shapes it; a null part is not an absent or empty one."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p, F.lit("\u0000null")) for p in parts]), 256)
