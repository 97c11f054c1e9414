"""Secrets in texts, also in encoded layers of them.

Every text is the first item of a worklist. An item is scanned for secrets,
and what can be unwrapped in it becomes new items: the text with its URL
escapes decoded, with its Unicode escapes and character references decoded,
and the text of each base64 run (plain or URL-safe signs), over line breaks
too, decompressed if it is compressed: all members and streams of it, one
after the other. What isn't text in UTF-8 counts with its readable parts of 12
signs and more, one byte or two each: UTF-16, other encodings, members of an
archive. Escapes of escapes lose all levels but the last in one step, so deep
nesting takes few layers. Each layer
keeps, for every character, the span of the original text it comes from, so
a find in any layer is a span of the original text. A layer that was seen
before (same text from the same place) is not scanned again; every layer is
shorter than its parent or a decompression of it, so the list runs empty.

Kinds, leftmost and not overlapping within a kind and layer: ``assign`` (a
name such as password or token, a sign and a value of 6 or more characters),
``access`` (AKIA..., 20 or more), ``hex`` (24 or more lower-case digits).
Finds of the first layer are the base; those of deeper layers are added, a
span that is found twice counts once. Spans are in code points, end exclusive.

Of finds of a kind that begin at the same place in different layers, each
different end is a span. Null text counts as empty and has no spans. An empty
table gives an empty table; ``mask_secrets`` keeps every column, whatever its
name, and ``find_secrets`` reads only those named. Rows are kept one by one,
whatever their ids. Texts of any length are scanned whole. A layer that unwraps
to more than ``MOST_HELD`` bytes is read to its end as a stream, in chunks that
end where no find and no run goes on; held are its head and the chunk at hand,
which grows with the longest run. A damaged or cut archive counts as far as it
can be read. An archive of more than ``MOST_HELD`` bytes counts as unpacking to
itself if the first ``MOST_HELD`` bytes are the same.

A wrapped run is a chain of lines of base64 signs. Lines of one width with a
shorter one behind (and before) them, and the whole chain, are tried, the
longest first; one that decodes to text stands for all its lines. A run whose
archive ends with the last line goes before one with more behind the archive.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterable, Iterator
from html import unescape
from itertools import chain, groupby

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from roomtide.llm.text import map_batches, one_column

MOST_HELD = 64 << 20
ZLIB = type(zlib.decompressobj())
CHUNK, STEP, SLICE = 4 << 20, 1 << 20, 1 << 16  # characters of a chunk; bytes of a step's output and input

# The patterns of the base finds and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex")

URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"(?:\\u\{[0-9A-Fa-f]{1,6}\}|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#[xX]?[0-9A-Fa-f]{1,7};|&(?:quot|apos|amp|equals|colon|lowbar|sol|plus|period|dash|hyphen);)+")
ONE_ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|(&[^;]+;)")
#: One level of nested escapes: what only stands for the sign in front of the next level.
NESTED = re.compile(r"%(?:25){2,}(?=[0-9A-Fa-f]{2})|\\(?:u005[cC]){2,}(?=u[0-9A-Fa-f]{4})|&(?:amp;){2,}(?=#?\w{1,8};)")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
PLAIN64 = re.compile(r"[A-Za-z0-9+/]{16,}={0,2}")
#: Readable parts of other bytes, long enough for the shortest find: plain, and with a zero byte behind or before each sign.
READABLE = re.compile(rb"[\t\n\r\x20-\x7e]{12,}|(?:[\t\n\r\x20-\x7e]\x00){12,}|(?:\x00[\t\n\r\x20-\x7e]){12,}")
LINE = re.compile(r"[A-Za-z0-9+/_-]++={0,2}")
BREAK = re.compile(r"[ \t]*+\r?\n[ \t]*+")
BEFORE = re.compile(r"(?<![A-Za-z0-9+/_-])([A-Za-z0-9+/_-]{1,15})[ \t]*+\r?\n[ \t]*+\Z")
#: A sign that ends every find and every run.
APART = re.compile(r"""[^A-Za-z0-9+/_.=:"'%\\{}&#;\s-]""")

Span = tuple[int, int, int]  # start, end, number of the kind


class Layer:
    """A text; ``starts`` and ``ends`` say where in the original each character comes from."""

    __slots__ = ("text", "starts", "ends")

    def __init__(self, text: str, starts, ends):
        self.text, self.starts, self.ends = text, starts, ends

    def span(self, a: int, b: int) -> tuple[int, int]:
        return self.starts[a], self.ends[b - 1]


class _All:
    """One place for every character."""

    __slots__ = ("at",)

    def __init__(self, at: int):
        self.at = at

    def __getitem__(self, k):
        return self.at if isinstance(k, int) else _All(self.at)


def finds(text: str) -> list[tuple[int, int, int]]:
    """Base finds in a text as (start, end, kind)."""
    out = []
    low = text.lower()
    if "passw" in low or "secret" in low or "token" in low or "apikey" in low or "api_key" in low:
        out += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return out


def _rewritten(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with every match of ``pattern`` decoded; ``decode`` gives (characters, width of each in the match)."""
    text, pieces, starts, ends, at = layer.text, [], [], [], 0
    for m in pattern.finditer(text):
        decoded = decode(m[0])
        if decoded is None:
            continue
        chars, widths = decoded
        pieces += [text[at:m.start()], chars]
        starts += layer.starts[at:m.start()] if not isinstance(layer.starts, _All) else [layer.starts.at] * (m.start() - at)
        ends += layer.ends[at:m.start()] if not isinstance(layer.ends, _All) else [layer.ends.at] * (m.start() - at)
        k = m.start()
        for w in widths:
            starts.append(layer.starts[k])
            ends.append(layer.ends[k + w - 1])
            k += w
        at = m.end()
    if not pieces:
        return None
    n = len(text)
    pieces.append(text[at:])
    starts += layer.starts[at:n] if not isinstance(layer.starts, _All) else [layer.starts.at] * (n - at)
    ends += layer.ends[at:n] if not isinstance(layer.ends, _All) else [layer.ends.at] * (n - at)
    return Layer("".join(pieces), starts, ends)


def _url(run: str) -> tuple[str, list[int]] | None:
    raw = bytes.fromhex(run.replace("%", ""))
    chars, widths, k = [], [], 0
    while k < len(raw):
        n = 1 if raw[k] < 0x80 else 2 if raw[k] >> 5 == 6 else 3 if raw[k] >> 4 == 14 else 4 if raw[k] >> 3 == 30 else 0
        try:
            c = raw[k:k + n].decode() if n else ""
        except UnicodeDecodeError:
            c = ""
        if len(c) != 1:
            c, n = "\ufffd", 1
        chars.append(c)
        widths.append(3 * n)
        k += n
    return "".join(chars), widths


def _unicode(run: str) -> tuple[str, list[int]] | None:
    chars, widths = [], []
    for m in ONE_ESCAPE.finditer(run):
        if m[5]:
            c = unescape(m[5])
        else:
            code = int(m[1] or m[2] or m[3] or m[4], 16)
            if chars and len(widths) and 0xDC00 <= code < 0xE000 and 0xD800 <= ord(chars[-1]) < 0xDC00:
                chars[-1] = chr(0x10000 + ((ord(chars[-1]) - 0xD800) << 10) + code - 0xDC00)
                widths[-1] += len(m[0])
                continue
            c = chr(code) if code < 0x110000 else "\ufffd"
        chars.append(c if len(c) == 1 else "\ufffd")
        widths.append(len(m[0]))
    return ("".join("\ufffd" if 0xD800 <= ord(c) < 0xE000 else c for c in chars), widths) if chars else None


class _Long:
    """Content of more than ``MOST_HELD`` bytes: its head, and all of it as a stream that can be read once."""

    __slots__ = ("head", "pieces")

    def __init__(self, head: bytes, pieces: Iterator[bytes]):
        self.head, self.pieces = head, chain([head], pieces)


def _decompressor(head: bytes):
    """A new one for the kind of archive that starts so."""
    if head[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if head[:1] == b"\x78" and len(head) > 2 and int.from_bytes(head[:2], "big") % 31 == 0:
        return zlib.decompressobj()
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    if head[:4] == b"\x28\xb5\x2f\xfd":
        return zstandard.ZstdDecompressor(max_window_size=1 << 31).decompressobj()
    return None


def _slices(pieces: Iterable[bytes]) -> Iterator[bytes]:
    return (piece[k:k + SLICE] for piece in pieces for k in range(0, len(piece), SLICE))


def _member(d, data: bytes, more: Iterator[bytes]):
    """Yields the content of one member that starts with ``data``; returns the bytes behind it, None if it has no end."""
    while True:
        if hasattr(d, "needs_input"):
            yield d.decompress(data, STEP)
            while not d.eof and not d.needs_input:
                yield d.decompress(b"", STEP)
            data = d.unused_data if d.eof else b""
        elif isinstance(d, ZLIB):
            yield d.decompress(data, STEP)
            data = d.unused_data if d.eof else d.unconsumed_tail
        else:  # zstandard has no limit of its output: little input at a time
            yield d.decompress(data[:1024])
            data = (d.unused_data or b"") + data[1024:] if d.eof else data[1024:]
        if d.eof:
            return data
        if not data and not (data := next(more, b"")):
            if isinstance(d, ZLIB):
                yield d.flush()
            return None


def _inflated(pieces: Iterable[bytes], clean: list) -> Iterator[bytes]:
    """The content of all members; ``clean`` gets an entry if they and nothing else were the input."""
    more, rest = _slices(pieces), b""
    try:
        while True:
            while len(rest) < 6 and (piece := next(more, b"")):
                rest = (rest + piece).lstrip(b"\0")  # streams may be padded
            if not rest:
                clean.append(True)
                return
            if rest[:1] != b"\0" and rest[1:4] == b"\x2a\x4d\x18" and rest[0] >> 4 == 5:  # a frame of zstandard to be skipped
                while len(rest) < 8 and (piece := next(more, b"")):
                    rest += piece
                length = 8 + int.from_bytes(rest[4:8], "little")
                while len(rest) < length and (piece := next(more, b"")):
                    length, rest = length - len(rest), piece
                rest = rest[length:]
                continue
            if (d := _decompressor(rest)) is None:
                break
            if (rest := (yield from _member(d, rest, more))) is None:
                return
            rest = rest.lstrip(b"\0")
    except (zlib.error, OSError, lzma.LZMAError, zstandard.ZstdError, EOFError, ValueError):
        return
    behind = rest + b"".join(more)
    if _text(behind) is not None:
        yield behind


def _unpacked(raw: bytes | _Long) -> bytes | _Long | None:
    """The content if it is compressed."""
    head = raw if isinstance(raw, bytes) else raw.head
    if _decompressor(head) is None or not any(_inflated([head], [])):
        return None
    clean: list = []
    pieces = _inflated([raw] if isinstance(raw, bytes) else raw.pieces, clean)
    held, size = [], 0
    for piece in pieces:
        held.append(piece)
        size += len(piece)
        if size > MOST_HELD:
            return _Long(b"".join(held), pieces)
    if not clean and isinstance(raw, bytes) and _text(raw) is not None:
        return None  # a text that only starts like an archive
    return b"".join(held)


def _text(raw: bytes, cut: bool = False) -> str | None:
    """The bytes as text, if they are; with ``cut`` the last character may be cut."""
    try:
        text = codecs.getincrementaldecoder("utf-8")().decode(raw, not cut)
    except UnicodeDecodeError:
        return None
    return text if text and _shown(text) >= 0.9 * len(text) else None


def _readable(raw: bytes) -> str | None:
    """The readable parts of bytes that aren't text in UTF-8: other encodings, members of archives, binary files."""
    parts = [m.replace(b"\x00", b"").decode("ascii") for m in READABLE.findall(raw)]
    return "\n\n".join(parts) or None


def _shown(text: str) -> int:
    return sum(c.isprintable() or c in "\n\r\t" for c in text)


def _decoded(run: str) -> bytes | None:
    core = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(core) % 4 == 1:
        return None
    try:
        return base64.b64decode(core + "=" * (-len(core) % 4))
    except (binascii.Error, ValueError):
        return None


def _base64(run: str, loose: bool = True) -> str | _Long | None:
    """Text of a base64 run, or if ``loose`` its readable parts, through any number of compressions; None if there is none."""
    if (raw := _decoded(run)) is None:
        return None
    digest = lambda x: hashlib.blake2b(x if isinstance(x, bytes) else x.head).digest()
    met = {digest(raw)}
    while (inner := _unpacked(raw)) is not None and digest(inner) not in met:  # some archives unpack to themselves
        met.add(digest(inner))
        raw = inner
    return _text(raw, len(met) > 1) or (_readable(raw) if loose else None) if isinstance(raw, bytes) else raw


def _last_apart(text: str) -> int | None:
    """Behind the last sign that ends every find and run."""
    for k in range(len(text) - 1, -1, -4096):
        if found := [m.end() for m in APART.finditer(text, max(0, k - 4095), k + 1)]:
            return found[-1]
    return None


def _kinds(content: _Long) -> set[int]:
    """The kinds of the finds in all layers of a long content; bytes that aren't text are signs that end a find."""
    head = content.head[:1 << 16]
    wide = [n for n, part in (("utf-16-le", head[1::2]), ("utf-16-be", head[::2])) if 2 * part.count(0) > len(part)]
    decoder = codecs.getincrementaldecoder(wide[0] if wide else "utf-8")("replace")
    kinds: set[int] = set()
    held, size = [], 0

    def scanned(text: str):
        kinds.update(kind for _, _, kind in scan(text)[1])

    for piece in content.pieces:
        for k in range(0, len(piece), STEP):
            text = decoder.decode(piece[k:k + STEP])
            cut = _last_apart(text) if size + len(text) >= CHUNK else None
            held.append(text if cut is None else text[:cut])
            size += len(text)
            if cut is not None:
                scanned("".join(held))
                held, size = [text[cut:]], len(text) - cut
    scanned("".join(held))
    return kinds


def _wrapped(t: str, start: int) -> list[tuple[int, int]]:
    """The lines of the run at ``start``, with a short one before it."""
    first = LINE.match(t, start)
    lines = [first.span()]
    while t[lines[-1][1] - 1] != "=" and (gap := BREAK.match(t, lines[-1][1])) and (line := LINE.match(t, gap.end())) and not line[0].startswith("--"):
        lines.append(line.span())
    if m := BEFORE.search(t, max(0, start - 64), start):
        lines.insert(0, m.span(1))
    return lines


def _joins(lines: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """First and last line of what may be one run, longest first."""
    found, at = {(0, len(lines) - 1)}, 0
    for width, same in groupby(b - a for a, b in lines):
        i, j = at, at + sum(1 for _ in same) - 1
        at = j + 1
        if width >= 16:
            short = lambda k: 0 <= k < len(lines) and lines[k][1] - lines[k][0] < width
            found |= {(x, y) for x in ((i, i - 1) if short(i - 1) else (i,)) for y in ((j, j + 1) if short(j + 1) else (j,))}
    return sorted(((i, j) for i, j in found if j > i), key=lambda x: (lines[x[0]][0] - lines[x[1]][1], x))


def _clean(run: str) -> bool:
    raw, clean = _decoded(run), []
    if raw is None or _decompressor(raw) is None:
        return raw is not None
    for _ in _inflated([raw], clean):
        pass
    return bool(clean)


def _base64_runs(t: str) -> Iterator[tuple[int, int, str | _Long]]:
    """Start, end and content of every run that holds text, also over line breaks."""
    upto, runs = 0, []  # end of the lines looked at; what was joined of them
    for m in BASE64.finditer(t):
        if m.start() >= upto and len(lines := _wrapped(t, m.start())) > 1:
            upto, taken = lines[-1][1], []
            joins = [(i, j, "".join(t[a:b] for a, b in lines[i:j + 1])) for i, j in _joins(lines)]
            for clean, loose in ((True, False), (False, False), (True, True), (False, True)):
                for i, j, run in joins:
                    if all(j < x or i > y for x, y in taken) and _clean(run) == clean and (inner := _base64(run, loose)) is not None:
                        taken.append((i, j))
                        yield lines[i][0], lines[j][1], inner
            runs = [(lines[i][0], lines[j][1]) for i, j in taken]
        elif m.start() >= upto:
            runs = []
        if not any(a <= m.start() < b for a, b in runs):
            if (inner := _base64(m[0])) is not None:
                yield m.start(), m.end(), inner
            if "-" in m[0] or "_" in m[0]:  # a run of the plain signs beside a dash
                for part in PLAIN64.finditer(m[0]):
                    if (inner := _base64(part[0])) is not None:
                        yield m.start() + part.start(), m.start() + part.end(), inner


def scan(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans, each sorted by start and kind."""
    base = [(a, b, kind) for a, b, kind in finds(text)]
    every = set(base)
    work: list[Layer] = []
    seen: set[tuple[int, bytes]] = set()

    def add(layer: Layer | None):
        if layer and layer.text:
            key = (layer.starts[0], hashlib.blake2b(layer.text.encode("utf-8", "replace"), digest_size=16).digest())
            if key not in seen:
                seen.add(key)
                work.append(layer)

    def unwrap(layer: Layer):
        t = layer.text
        if nested := _rewritten(layer, NESTED, lambda run: (run[0], [len(run)])):
            add(nested)  # its escapes are decoded there
        else:
            if "%" in t:
                add(_rewritten(layer, URL, _url))
            if "\\" in t or "&" in t:
                add(_rewritten(layer, ESCAPE, _unicode))
        for start, end, inner in _base64_runs(t):
            a, b = layer.span(start, end)
            if isinstance(inner, _Long):
                every.update((a, b, kind) for kind in _kinds(inner))
            else:
                add(Layer(inner, _All(a), _All(b)))

    unwrap(Layer(text, range(len(text)), range(1, len(text) + 1)))
    while work:
        layer = work.pop()
        for a, b, kind in finds(layer.text):
            every.add((*layer.span(a, b), kind))
        unwrap(layer)
    order = lambda s: (s[0], s[2], s[1])
    return sorted(base, key=order), sorted(every, key=order)


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, b, kind in spans)


def masked(text: str, spans: list[Span], mask: str = "[SECRET]") -> str:
    """The text with each span, or run of overlapping spans, replaced."""
    out, at, end = [], 0, -1
    for a, b, _ in sorted(spans):
        if a >= end:
            if end >= 0:
                at = end
            out += [text[at:a], mask]
        end = max(end, b)
    return "".join(out) + text[end if end >= 0 else 0:]


def find_secrets(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row the counts of base finds, a digest of them, and all spans."""
    def run(batch: pa.RecordBatch):
        rows = []
        for x in batch.column(1).to_pylist():
            base, every = scan(x or "")
            counts = [sum(s[2] == k for s in base) for k in range(3)]
            rows.append((*counts, hashlib.sha256(written(base).encode()).hexdigest(), written(every)))
        kinds = [pa.int64()] * 3 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, k) for v, k in zip(zip(*rows), kinds))], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    kind = df.schema[doc_id].dataType.simpleString()
    return map_batches(one_column(df, doc_id=doc_id, text=text), run, f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")


def mask_secrets(df: DataFrame, text: str = "text", mask: str = "[SECRET]", n_chars: str | None = None) -> DataFrame:
    """``df`` with the spans in ``text`` masked; null stays null. ``n_chars`` names a column to set to the new length where a text changed."""
    names, at = df.columns, df.columns.index(text)
    count = df.columns.index(n_chars) if n_chars in df.columns else None

    def run(batch: pa.RecordBatch):
        old = batch.column(at).to_pylist()
        new = [x and masked(x, scan(x)[1], mask) for x in old]
        columns = batch.columns
        columns[at] = pa.array(new, pa.string())
        if count is not None:
            counts = [len(y) if x != y else n for x, y, n in zip(old, new, columns[count].to_pylist())]
            columns[count] = pa.array(counts, columns[count].type)
        yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_batches(df, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields))
