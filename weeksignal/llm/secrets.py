"""Secret scans with a recursive decoding worklist.

A text is the first layer. Every layer is scanned; its URL escapes, Unicode escapes, base64
runs and compressed base64 runs give further layers, until no new layer appears. A layer
that was seen before at the same place is not entered again, so a decoding that leads back
to itself ends. Each layer carries the stretches of the original text that its characters
come from, and what is found is reported at these places.

Defined cases: a null or empty text has no span; what decodes to no text is scanned byte by
byte, and is a layer if something is found; equal spans of one kind count once; repeated rows are scanned one by one; an
empty table gives an empty result. Texts are scanned whole, and so is what a compressed run
unpacks to: all its members, beyond ``MAX_LAYER`` in windows, each a layer. ``truncated`` tells
that a run of more than twice this length had to be split; redaction then replaces all of it.
"""

from __future__ import annotations

import base64
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from weeksignal.llm.rows import texts

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?ia)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Runs of 24 and more are the maximal runs that are long enough.
HEX = re.compile(r"[0-9a-f]{24,}")

#: Longer unpacked data is scanned in windows of about this length.
MAX_LAYER = 1 << 26
PIECE = 1 << 20
#: Redacted texts that a worker holds at a time.
TEXTS = 64
_CONTROL = re.compile(r"[\x00-\x08\x0e-\x1f]")
#: Where no match, escape or base64 run goes on: behind other characters, an empty line, a line's last word that is no full line of base64, or between two words.
_BREAK = re.compile(r"""[^A-Za-z0-9+/_=.\-%\\&#;{}\x20"':\r\n]|\n\r?\n|[\x20\n][A-Za-z0-9+/_=.-]{0,40}\r?\n|(?:[A-Za-z0-9]{10}|\x20[A-Za-z0-9]{1,9})\x20(?=[A-Za-z0-9])""")

_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(
    r"(?:\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};)+"
)
_UNIT = re.compile(r"\\u([0-9A-Fa-f]{4})|\\u\{([0-9A-Fa-f]+)\}|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#([0-9]+);|&#[xX]([0-9A-Fa-f]+);")
#: One byte a code point: a small letter, another base64 character, anything else.
_CASES = bytes(97 if 97 <= c <= 122 else 98 if chr(c) in "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-" else 32 for c in range(256))
_HEX_CASES = bytes(97 if chr(c) in "0123456789abcdef" else 32 for c in range(256))
#: Base64 runs that are no plain word: encoded text of 12 characters has capitals or digits behind the first one.
_RUN = re.compile(rb"(?<![ab])[ab]a*+b[ab]*+")
LEAST_RUN = 12
_KEYWORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")

Span = tuple[int, int, int]  # start, kind's place in KINDS, end


def flat(text: str) -> bytes:
    """One byte for each code point, for the quick tests; what is not Latin-1 becomes a question mark."""
    return text.encode("latin-1", "replace")


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches per kind, in order."""
    found, data = [], flat(text)
    lower = data.lower()
    if any(word in lower for word in _KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if b"AKIA" in data:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if b"a" * 24 in data.translate(_HEX_CASES):
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


@dataclass
class Layer:
    """Text and its origin: stretches (start here, start and end in the original, step).

    With step 1 characters stand for themselves; with step 0 each stands for the whole stretch.
    """

    text: str
    origin: list[tuple[int, int, int, int]]

    @cached_property
    def starts(self) -> list[int]:
        return [o[0] for o in self.origin]

    def place(self, start: int, end: int) -> tuple[int, int]:
        a, b = (self.origin[bisect_right(self.starts, k) - 1] for k in (start, end - 1))
        first = a[1] + (start - a[0]) if a[3] else a[1]
        last = b[1] + (end - 1 - b[0]) + 1 if b[3] else b[2]
        return first, last


def _replaced(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with all escapes decoded; None if there is none."""
    parts, origin, at, done = [], [], 0, 0
    for m in pattern.finditer(layer.text):
        origin += _carried(layer, done, m.start(), at)
        parts.append(layer.text[done : m.start()])
        at += m.start() - done
        for start, end, new in decode(m.group()):
            origin.append((at, *layer.place(m.start() + start, m.start() + end), 0))
            parts.append(new)
            at += len(new)
        done = m.end()
    if not done:
        return None
    origin += _carried(layer, done, len(layer.text), at)
    return Layer("".join(parts) + layer.text[done:], origin)


def _carried(layer: Layer, start: int, end: int, at: int) -> list[tuple[int, int, int, int]]:
    """The origin of ``layer.text[start:end]``, moved to position ``at``."""
    out = []
    for k in range(bisect_right(layer.starts, start) - 1, len(layer.origin)):
        here, first, last, step = layer.origin[k]
        if here >= end:
            break
        skip = max(0, start - here)
        out.append((at + max(here, start) - start, first + skip if step else first, last, step))
    return out


def _url(run: str) -> list[tuple[int, int, str]]:
    """Start, end and text of each decoded unit: a character if all are ASCII, else the run."""
    data = bytes.fromhex(run.replace("%", ""))
    if data.isascii():
        return [(3 * k, 3 * k + 3, chr(b)) for k, b in enumerate(data)]
    return [(0, len(run), data.decode("utf-8", "replace"))]


def _unicode(run: str) -> list[tuple[int, int, str]]:
    """As ``_url``; \\x units that form UTF-8 are read as bytes, surrogate pairs are joined."""
    units = [
        (m.start(), m.end(), int(m.group(5)) if m.group(5) else int(next(g for g in m.groups() if g), 16), m.group(4))
        for m in _UNIT.finditer(run)
    ]
    if all(n < 128 for _, _, n, _ in units):
        return [(a, b, chr(n)) for a, b, n, _ in units]
    if all(raw for *_, raw in units):
        try:
            return [(0, len(run), bytes(n for _, _, n, _ in units).decode("utf-8"))]
        except UnicodeDecodeError:
            pass
    joined = "".join(chr(n) if n < 0x110000 else "\ufffd" for _, _, n, _ in units)
    return [(0, len(run), joined.encode("utf-16", "surrogatepass").decode("utf-16", "replace"))]


def _opener(head: bytes):
    """A decompressor for data that begins so; None if it is no known format."""
    if head[:2] == b"\x1f\x8b" or (len(head) > 2 and head[0] & 15 == 8 and (head[0] << 8 | head[1]) % 31 == 0):
        return zlib.decompressobj(47)
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head[:6] == b"\xfd7zXZ\x00" or head[:3] == b"\x5d\x00\x00":
        return lzma.LZMADecompressor()
    return zstandard.ZstdDecompressor().decompressobj() if head[:4] == b"\x28\xb5\x2f\xfd" else None


#: Decompressors that take a bound for what they put out.
_BOUNDED = (type(zlib.decompressobj()), bz2.BZ2Decompressor, lzma.LZMADecompressor)


class _Source:
    """Pieces of bytes, taken in any lengths."""

    def __init__(self, *pieces: Iterable[bytes]):
        self.pieces, self.held = chain(*pieces), []
        #: Whether a member breaks off; bytes behind the last one, as far as they are held.
        self.partial, self.behind = False, 0

    def put(self, data: bytes) -> None:
        if len(data):
            self.held.append(memoryview(data))

    def take(self, most: int) -> bytes:
        while not self.held:
            if (data := next(self.pieces, None)) is None:
                return b""
            self.put(data)
        data = self.held.pop()
        self.put(data[most:])
        return bytes(data[:most])

    def head(self) -> bytes:
        data = b""
        while len(data) < 6 and (more := self.take(6 - len(data))):
            data += more
        self.put(data)
        return data


def _members(source: _Source) -> Iterator[bytes]:
    """Unpacked pieces of all members, streams or frames, then what follows them."""
    while (opened := _opener(source.head())) is not None:
        bound = (PIECE,) if isinstance(opened, _BOUNDED) else ()
        while not opened.eof and (data := source.take(PIECE if bound else 256)):
            while True:
                if out := opened.decompress(data, *bound):
                    yield out
                data = getattr(opened, "unconsumed_tail", b"")
                if opened.eof or not bound or not data and len(out) < PIECE and getattr(opened, "needs_input", True):
                    break
        source.partial = not opened.eof
        source.put(opened.unused_data)
    if source.head():
        source.behind = sum(map(len, source.held))
        yield b"\0"
    while data := source.take(PIECE):
        yield data


_FAULTS = (zlib.error, OSError, ValueError, EOFError, lzma.LZMAError, zstandard.ZstdError)


def _filled(pieces: Iterator[bytes]) -> tuple[bytes, bool, bool]:
    """Pieces up to ``MAX_LAYER`` bytes, whether there may be more, and whether they end in a fault."""
    parts, size = [], 0
    try:
        for piece in pieces:
            parts.append(piece)
            size += len(piece)
            if size > MAX_LAYER:
                return b"".join(parts), True, False
    except _FAULTS:
        return b"".join(parts), False, True
    return b"".join(parts), False, False


def _plain(data: bytes) -> str | None:
    """Bytes as text without control characters."""
    for coding in ("utf-8", "utf-16-le") if b"\0" in data[:4] else ("utf-8",):
        try:
            text = data.decode(coding)
        except UnicodeDecodeError:
            continue
        if not _CONTROL.search(text):
            return text
    return None


def _raw(data: bytes) -> list[str]:
    """Other bytes as the patterns can be found in them."""
    return [data.decode("latin-1"), *([data.decode("utf-16-le", "replace")] if b"\0" in data else [])]


def _windows(pieces: Iterable[bytes], coding: str) -> Iterator[tuple[str, bool]]:
    """Long text in windows that end where no match and no run goes on.

    A single run of over ``2 * MAX_LAYER`` characters is split with an overlap, which is told: matches
    are still found, but what it encodes is decoded in part.
    """
    decoder, text, wanted = codecs.getincrementaldecoder(coding)("replace"), "", MAX_LAYER
    try:
        for piece in chain(pieces, [b""]):
            text += re.sub(r"\x20{3,}", "  ", decoder.decode(piece, not piece))
            if len(text) < wanted:
                continue
            ends = [m.end() for m in _BREAK.finditer(text, max(0, len(text) - (1 << 16)))] or [m.end() for m in _BREAK.finditer(text)][-1:]
            if ends:
                yield text[: ends[-1]], False
                text, wanted = text[ends[-1] :], MAX_LAYER
            elif len(text) >= 2 * MAX_LAYER:
                yield text, True
                text, wanted = text[-64:], MAX_LAYER
            else:
                wanted = 2 * MAX_LAYER
    except _FAULTS:
        pass
    if text:
        yield text, False


def _packed(run: str) -> str:
    """The base64 characters of a run."""
    return re.sub(r"\s", "", run).rstrip("=").replace("-", "+").replace("_", "/")


def _bytes(packed: str) -> bytes:
    packed = packed[: len(packed) - (len(packed) % 4 == 1)]
    return base64.b64decode(packed + "=" * (-len(packed) % 4))


def _unpacked(run: str) -> tuple[bool, Iterator[tuple[str, bool, bool]], bool]:
    """Whether text is behind a base64 run, through any number of compressed layers, what is behind it, and whether it breaks off.

    Behind it are texts, whether each is of undecodable bytes, and whether the guard struck.
    """
    data = _bytes(_packed(run))
    seen, more, broken, partial = set(), (), [], False
    while _opener(data[:6]) is not None and (digest := hashlib.blake2b(data).digest()) not in seen:
        seen.add(digest)
        source = _Source([data], more)
        members = _members(source)
        out, longer, fault = _filled(members)
        if fault and not more:
            broken.append(data)
        if fault and not out:
            break
        data, more, partial = out, members if longer else (), partial or source.partial
    plain = _plain(data) if not more else None

    def behind() -> Iterator[tuple[str, bool, bool]]:
        if more:
            coding = "utf-16-le" if b"\0" in data[:4] and not _CONTROL.search(data[:4096].decode("utf-16-le", "replace")) else "utf-8"
            yield from ((text, False, cut) for text, cut in _windows(chain([data], more), coding))
        elif plain is not None:
            yield plain, False, False
        for rest in broken if more or plain is not None else [data, *broken]:
            yield from ((text, True, False) for text in _raw(rest))

    return bool(more) or plain is not None and not broken, behind(), partial


def _runs(text: str) -> list[tuple[int, int]]:
    """Base64 runs with their padding; lines of 64 or 76 characters and what follows them are one run."""
    runs: list[tuple[int, int]] = []
    data = flat(text)
    if LEAST_RUN <= len(data):
        wrapped = False
        for m in _RUN.finditer(data.translate(_CASES)):
            start, end = m.span()
            if wrapped and data[runs[-1][1] : start] in (b"\n", b"\r\n"):
                runs[-1] = (runs[-1][0], end)
            elif end - start >= LEAST_RUN:
                runs.append((start, end))
            else:
                wrapped = False
                continue
            wrapped = end - start in (64, 76)
    return [(a, b + len(re.match("={0,2}", text[b : b + 2]).group())) for a, b in runs]


def _transparent(layer: Layer) -> list[Layer]:
    """Layers with all escapes of a kind decoded."""
    text, out = layer.text, []
    if "%" in text and (url := _replaced(layer, _URL, _url)):
        out.append(url)
    if ("\\" in text or "&#" in text) and (plain := _replaced(layer, _UNICODE, _unicode)):
        out.append(plain)
    return out


def _good(data: bytes) -> int:
    """How many bytes from the start on are text."""
    most = 0
    for coding, width in (("utf-8", 0), ("utf-16-le", 2)) if b"\0" in data[:4] else (("utf-8", 0),):
        try:
            text = data.decode(coding)
        except UnicodeDecodeError as error:
            text = data[: error.start].decode(coding)
        if m := _CONTROL.search(text):
            text = text[: m.start()]
        most = max(most, width * len(text) or len(text.encode()))
    return most


def _extent(packed: str, start: int) -> int:
    """Up to where a run decodes, or up to where what is compressed in it goes, from a start on; in units of four characters."""
    size = 64
    while True:
        data = _bytes(packed[start : start + size])
        if size == 64 and _opener(data[:6]) is not None:
            source = _Source([_bytes(packed[start:])])
            if not _filled(_members(source))[2]:
                return start + (len(packed) - start) // 4 * 4 - source.behind // 3 * 4 if source.behind else len(packed)
        good = _good(data)
        if good < len(data) - 3 or start + size >= len(packed):
            return start + good // 3 * 4
        size *= 2


def _parts(run: str) -> Iterator[tuple[int, int, Iterator[tuple[str, bool, bool]]]]:
    """What is in a run that is no text as a whole: a path may stand before it, or a word of the next line behind it.

    Stretches that decode by themselves, from a line's start or behind one of / _ + - up to a line's
    end or one of these; what is left over is read as bytes, from each of the four places it can be aligned to.
    """
    gone, starts, ends = 0, [(0, 0)], []
    for m in re.finditer(r"[/_+-]|\r?\n", run):
        if not ends or ends[-1][0] < m.start() - gone:
            ends.append((m.start() - gone, m.start()))
        gone += len(m.group()) if m.group()[-1] == "\n" else 0
        starts.append((m.end() - gone, m.end()))
    packed = _packed(run)
    ends.append((len(packed), len(run)))
    left, done = [], 0
    for here, start in starts:
        if start < done or len(packed) - here < LEAST_RUN:
            continue
        at = bisect_right(ends, (_extent(packed, here) + 3, len(run)))
        for there, end in [e for e in ends[max(0, at - 8) : at] if e[0] - here >= LEAST_RUN and (e[0] - here) % 4 != 1][::-1]:
            found = _unpacked(run[start:end])
            if found[0] and not found[2]:
                left.append((done, start))
                yield start, end, found[1]
                done = end
                break
    for first, last in [*left, (done, len(run))]:
        aligned: dict[int, int] = {}
        for here, start in starts:
            if first <= start <= last - LEAST_RUN:
                aligned.setdefault(here % 4, start)
        for start in aligned.values():
            yield start, last, _unpacked(run[start:last])[1]


def _encoded(text: str) -> Iterator[tuple[int, int, Iterator[tuple[str, bool, bool]]]]:
    """Start and end of each encoded run, and what is behind it (see ``_unpacked``)."""
    for start, end in _runs(text):
        found = _unpacked(text[start:end])
        if found[0]:
            yield start, end, found[1]
        else:
            yield from ((start + a, start + b, behind) for a, b, behind in _parts(text[start:end]))


def _key(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass")).digest()


@dataclass
class Opened:
    """What a text from one stretch holds: kinds, the keys of its layers, and whether the guard struck in them."""

    kinds: set[int]
    inside: set[bytes]
    cut: bool = False


def _open(text: str, raw: bool, opened: dict[bytes, Opened], empty: set[bytes]) -> bytes:
    """The key of a text; it and all layers below are added to ``opened``, ``empty`` gets bytes in which nothing is."""
    stack: list[tuple[bytes, bool, Iterator[tuple[str, bool, bool]]]] = []

    def enter(text: str, raw: bool) -> bytes:
        key = _key(text)
        if key not in opened:
            opened[key] = Opened({kind for _, kind, _ in base_spans(text)}, set())
            layer = Layer(text, [(0, 0, 1, 0)])
            stack.append((key, raw, chain(
                ((x.text, raw, False) for x in _transparent(layer)), chain.from_iterable(x for *_, x in _encoded(text))
            )))
        return key

    root = enter(text, raw)
    while stack:
        key, bytes_only, rest = stack[-1]
        child = next(rest, None)
        if child is None:
            stack.pop()
            if bytes_only and not opened[key].kinds and opened[key].inside <= empty:
                empty.add(key)
        elif child[0]:
            opened[key].cut |= child[2]
            opened[key].inside.add(enter(*child[:2]))
    return root


def _search(text: str, base: list[Span]) -> tuple[set[Span], int, set[tuple[int, int]]]:
    """Spans of all layers, the number of different layers, and the stretches in which the guard struck.

    A layer from one stretch of the original is opened once per text, and its kinds are
    reported at every place that the text comes from. Of the layers of the whole text, equal
    ones are entered once: decoding keeps the order, so they have the same secrets.
    Undecodable bytes count as a layer if something is found in them.
    """
    found, whole, cut = set(base), {text}, set()
    opened: dict[bytes, Opened] = {}
    empty: set[bytes] = set()
    placed: set[tuple[bytes, int, int]] = set()
    work = [Layer(text, [(0, 0, len(text), 1)])] if text else []
    while work:
        layer = work.pop()
        inner: list[tuple[bytes, int, int]] = []
        for child in _transparent(layer):
            if len(child.origin) == 1 and not child.origin[0][3]:
                inner.append((_open(child.text, False, opened, empty), *child.origin[0][1:3]))
            elif child.text not in whole:
                whole.add(child.text)
                for start, kind, end in base_spans(child.text):
                    first, last = child.place(start, end)
                    found.add((first, kind, last))
                work.append(child)
        for start, end, behind in _encoded(layer.text):
            place = layer.place(start, end)
            for coded, raw, struck in behind:
                if struck:
                    cut.add(place)
                if coded:
                    inner.append((_open(coded, raw, opened, empty), *place))
        while inner:
            now = inner.pop()
            if now not in placed:
                placed.add(now)
                key, first, last = now
                found.update((first, kind, last) for kind in opened[key].kinds)
                if opened[key].cut:
                    cut.add((first, last))
                inner += [(inside, first, last) for inside in opened[key].inside]
    return found, len({_key(t) for t in whole} | opened.keys() - empty), cut


def all_spans(text: str, base: list[Span]) -> tuple[list[Span], int, bool]:
    """Spans of all layers, the number of different layers and whether the guard struck."""
    found, layers, cut = _search(text, base)
    return sorted(found), layers, bool(cut)


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


RESULT = (
    "struct<n_assign: long, n_access: long, n_hex: long, base_sha256: string, spans: string, "
    "n_layers: long, truncated: boolean>"
)
_RESULT_ARROW = pa.struct([
    ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()),
    ("spans", pa.string()), ("n_layers", pa.int64()), ("truncated", pa.bool_()),
])


def examine(text: str) -> dict:
    base = base_spans(text)
    spans, layers, cut = all_spans(text, base)
    kinds = [kind for _, kind, _ in base]
    return {
        "n_assign": kinds.count(0), "n_access": kinds.count(1), "n_hex": kinds.count(2),
        "base_sha256": hashlib.sha256(listed(base).encode()).hexdigest(), "spans": listed(spans),
        "n_layers": layers, "truncated": cut,
    }


def redacted(text: str, mark: str = "[REDACTED]") -> str:
    """The text with a mark in place of every span, scanned again until nothing is found."""
    while True:
        found, _, cut = _search(text, base_spans(text))
        spans = sorted(found | {(first, 0, last) for first, last in cut})  # what was not read whole is no clean text
        if not spans:
            break
        parts, done = [], 0
        for start, _, end in spans:
            if start >= done:
                parts += [text[done:start], mark]
            done = max(done, end)
        text = "".join(parts) + text[done:]
    return text


def _scan(column: pa.Array) -> pa.Array:
    return pa.array([examine(t) for t in texts(column)], _RESULT_ARROW)


def _redact(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Whole texts come back, so a few at a time: a batch of them is large as Python objects."""
    for batch in batches:
        for at in range(0, len(batch), TEXTS):
            yield pa.array([None if not v.is_valid else redacted(v.as_py()) for v in batch.slice(at, TEXTS)], pa.string())


def scan(text: Column) -> Column:
    """A column of ``RESULT`` for a column of texts."""
    return F.arrow_udf(_scan, RESULT)(text)


def redact(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """All documents, their secrets replaced; ``length``, if the table has it, is counted anew where a text changed."""
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns])
    rows = docs.select(row.alias("row"), F.arrow_udf(_redact, "string")(docs[f"`{text}`"]).alias("clean"))
    out = F.col("row").withField(f"`{text}`", F.col("clean"))
    if length in docs.columns:
        counted = F.when(F.col("clean").eqNullSafe(F.col("row")[text]), F.col("row")[length]).otherwise(
            F.length("clean").cast(docs.schema[length].dataType)
        )
        out = out.withField(f"`{length}`", counted)
    return rows.select(out.alias("row")).select("row.*")
