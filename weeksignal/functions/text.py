"""Phrase predicates and string clean-up as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Sponsor brands that are removed wherever they occur in a phrase.
SPONSOR_BRANDS = [
    "drata", "workos", "swarmia", "rippling", "warp", "sentry", "vanta",
    "lmnt", "snhu", "pacaso", "jurny", "brex", "retool", "notion",
    "linear", "coda", "vercel", "planetscale", "neon", "supabase",
    "clerk", "convex", "tigris", "axiom", "depot", "buildkite",
    "render", "railway", "fly.io", "koyeb", "zeet",
    "incogni", "surfshark", "nordvpn", "expressvpn",
    "grammarly", "jasper", "copy.ai", "writesonic",
    "masterclass", "brilliant", "skillshare", "coursera",
    "athletic greens", "ag1", "helix", "eight sleep",
    "1inch", "everyrealm", "futurex",
    "modern treasury", "mercury", "ramp",
    "anyscale", "modal", "baseten", "replicate",
    "butter", "contentful", "sanity",
    "cdata", "sage intacct",
]

# Patterns that mark a newsletter phrase as junk.
JUNK_PATTERNS = [
    r"subscribe|click here|read more|this week|last week|sign up",
    r"minute read|big read|quick read|deep dive",
    r"sponsor|sponsored|partner|advertisement",
    r"daily email|weekly email|newsletter|readers",
    r"hiring|remote|salary|interview|resume",
    r"2023|2024|2025|2026",
    r"tldr|import ai|bits bio|the batch|alphasense",
    r"^tech$|^ai$|^data$|^cloud$|^code$|^app$|^tool$|^api$",
    r"coffee break|behaviors make|feed uses|event start",
    r"development time|component library",
    r"specs features|colors price|benchmark report",
    r"reviewers rated|stars rating",
    r"electrolyte|sparkling|hydration|drinks try",
    r"vacation|save \dk",
]

# Openings that make a discovered topic label too generic.
GENERIC_LABEL_PREFIXES = ["tech startups", "big tech", "minute read"]

# Sources grouped by the kind of community they come from.
SOURCE_TYPES = {
    "arxiv": "research",
    "semantic_scholar": "research",
    "github": "developer",
    "reddit": "discussion",
    "hackernews": "discussion",
}

JUNK_REGEX = "|".join(JUNK_PATTERNS)
SPONSOR_REGEX = "|".join(re.escape(brand).replace("\\ ", " ") for brand in SPONSOR_BRANDS)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trie_pattern(words: list[str]) -> str:
    """A pattern for any of these literals, alternatives parted by their first letters.

    At most places of a text only the first letter is looked at, once for all words.
    """
    heads: dict[str, list[str]] = {}
    for word in words:
        heads.setdefault(word[:1], []).append(word[1:])
    if "" in heads:  # a word ends here, so longer ones add nothing
        return ""
    parts = []
    for head, rest in sorted(heads.items()):
        below = trie_pattern(rest)
        parts.append(re.escape(head).replace("\\ ", " ") + (f"(?:{below})" if "|" in below else below))
    return "|".join(parts)


def search_pattern(words: list[str]) -> str:
    """The same behind a look at the next letters, which no word fits at most places of a text."""
    look = "".join(f"[{''.join(re.escape(c) for c in sorted(set(letters)))}]" for letters in list(zip(*words))[:3])
    return f"(?={look})(?:{trie_pattern(words)})"


def _plain(pattern: str) -> bool:
    return not re.search(r"[\\^$.*+?()\[{]", pattern)


_JUNK = [part for pattern in JUNK_PATTERNS for part in pattern.split("|")]
_WHOLE = [part[1:-1] for part in _JUNK if part.startswith("^")]
_OTHER = [part for part in _JUNK if not _plain(part) and not part.startswith("^")]
JUNK_SEARCH = "|".join([search_pattern([part for part in _JUNK if _plain(part)]), *_OTHER])
WHOLE_SEARCH = f"^(?:{'|'.join(_WHOLE)})$"
SPONSOR_SEARCH = search_pattern(SPONSOR_BRANDS)


def junk_match(phrase) -> Column:
    """The junk patterns; those for whole phrases are asked for short phrases only."""
    low = F.lower(_col(phrase))
    short = F.char_length(low) <= max(map(len, _WHOLE)) + 2
    return (short & low.rlike(WHOLE_SEARCH)) | low.rlike(JUNK_SEARCH)


def sponsor_match(phrase) -> Column:
    """Substring test, so a brand inside a longer word counts as well."""
    return F.lower(_col(phrase)).rlike(SPONSOR_SEARCH)


def spaced_words(phrase) -> Column:
    """Number of pieces between single spaces."""
    return F.size(F.split(_col(phrase), " ", -1))


def whitespace_words(phrase) -> Column:
    """Number of words between runs of whitespace; 0 for blank text."""
    trimmed = F.regexp_replace(_col(phrase), r"^\s+|\s+$", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, r"\s+", -1)))


def generic_label(label) -> Column:
    lowered = F.lower(_col(label))
    test = F.lit(False)
    for prefix in GENERIC_LABEL_PREFIXES:
        test = test | lowered.startswith(prefix)
    return test


def concat_text(columns) -> Column:
    """Join text columns with one space; a missing column value is empty text."""
    return F.concat_ws(" ", *[F.coalesce(_col(c).cast("string"), F.lit("")) for c in columns])


def source_type(source, mapping: dict[str, str] | None = None, default: str = "other") -> Column:
    mapping = SOURCE_TYPES if mapping is None else mapping
    pairs = [F.lit(part) for item in mapping.items() for part in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), _col(source)), F.lit(default))


def title_case(c) -> Column:
    """First letter of each space-separated word in upper case."""
    return F.initcap(_col(c))


def truncate_label(c, length: int = 42) -> Column:
    return F.substring(_col(c), 1, length)


def star_flag(label, covered) -> Column:
    """Prefix a star where ``covered`` is 1."""
    return F.concat(F.when(_col(covered) == 1, F.lit("★ ")).otherwise(F.lit("")), _col(label))


# Letters, digits and underscore of any script, two or more in a row.
TOKEN_REGEX = r"[\p{L}\p{N}_]{2,}"


def tokens(text, stop_words=()) -> Column:
    """Lower-case word tokens of two characters or more, stop words removed."""
    found = F.regexp_extract_all(F.lower(_col(text)), F.lit(f"({TOKEN_REGEX})"), F.lit(1))
    stop = list(stop_words)
    if not stop:
        return found
    return F.filter(found, lambda w: ~w.isin(stop))


def ngrams(words, low: int = 1, high: int = 3) -> Column:
    """All runs of ``low`` to ``high`` neighbouring tokens, as phrases.

    Each length is the previous one zipped with the words shifted by one more place,
    so the work is linear in the text. Pass a column that holds the words, not the
    expression that cuts them, or they are cut again for every length.
    """
    words = _col(words)
    grams, current = [], words
    for n in range(1, high + 1):
        if n > 1:
            count = F.greatest(F.size(words) - (n - 1), F.lit(0))
            current = F.zip_with(
                F.slice(current, F.lit(1), count),
                F.slice(words, F.lit(n), count),
                lambda a, b: F.concat_ws(" ", a, b),
            )
        if n >= low:
            grams.append(current)
    return F.concat(*grams)
