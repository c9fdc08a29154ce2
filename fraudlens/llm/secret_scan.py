"""Secret scans with structural confirmation: what looks like an encoded key is decoded and parsed before it is reported.

Patterns alone give the base kinds. The further kinds are reported only if the bytes behind the text have the
structure of a key: DER private keys, whose nested lengths must fill each other exactly, key files of OpenSSH, whose
length-prefixed fields must, and signed tokens, whose header must be a JSON object that names its algorithm.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.llm.columns import hide

# Fixed: the base patterns, their kinds in order and the least lengths; ASCII only.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
BASE_KINDS = ("assign", "access", "hex")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18

KINDS = (*BASE_KINDS, "der_key", "openssh_key", "signed_token")

# Fixed: object identifiers (encoded) and the marks of the key formats.
RSA_ENCRYPTION = bytes.fromhex("2a864886f70d010101")
EC_PUBLIC_KEY = bytes.fromhex("2a8648ce3d0201")
PASSWORD_SCHEMES = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
CURVE_KEYS = (bytes.fromhex("2b656e"), bytes.fromhex("2b656f"), bytes.fromhex("2b6570"), bytes.fromhex("2b6571"))
OPENSSH_MAGIC = b"openssh-key-v1\0"
INTEGER, OCTET_STRING, OBJECT_ID, SEQUENCE = 0x02, 0x04, 0x06, 0x30

_LEAST_KEY = 40  # bytes of the shortest key of all, with its frame
_MOST_KEY = 1 << 16
_CONSTRUCTED = 0x20

Node = tuple[int, bytes, list]  # tag, content, children of a constructed one


def header(data: bytes) -> tuple[int, int] | None:
    """(size of tag and length, size of the content) of a DER element; None unless the length is minimal."""
    if len(data) < 2 or data[0] & 0x1F == 0x1F:
        return None
    if data[1] < 0x80:
        return 2, data[1]
    n = data[1] & 0x7F
    if not 1 <= n <= 4 or len(data) < 2 + n:
        return None
    size = int.from_bytes(data[2 : 2 + n])
    if size < 0x80 or size >> 8 * (n - 1) == 0:
        return None
    return 2 + n, size


def parse(data: bytes, depth: int = 12) -> list[Node] | None:
    """The elements that fill ``data`` exactly, with their children; None where a nested length does not fit."""
    out: list[Node] = []
    at = 0
    while at < len(data):
        found = header(data[at : at + 6])
        if not found:
            return None
        begin, end = at + found[0], at + found[0] + found[1]
        if end > len(data):
            return None
        tag, content, children = data[at], data[begin:end], []
        if tag & _CONSTRUCTED:
            inner = parse(content, depth - 1) if depth else None
            if inner is None:
                return None
            children = inner
        elif tag == INTEGER and (not content or len(content) > 1 and content[0] in (0, 0xFF) and content[0] >> 7 == content[1] >> 7):
            return None
        out.append((tag, content, children))
        at = end
    return out


def _tags(nodes: list[Node]) -> list[int]:
    return [n[0] for n in nodes]


def _number(node: Node) -> int:
    return int.from_bytes(node[1], signed=True)


def _form(fields: list[Node]) -> str:
    """Which traditional key the fields make up, "" for none.

    RSA or DSA: a version and positive integers; elliptic curve: a version, the secret, its curve and its point.
    """
    tags = _tags(fields)
    if tags[:1] != [INTEGER] or len(fields[0][1]) != 1:
        return ""
    version = _number(fields[0])
    if tags[:9] == [INTEGER] * 9 and tags[9:] in ([], [SEQUENCE]):
        return "rsa" if version == len(tags) - 9 and all(_number(f) > 0 for f in fields[1:9]) else ""
    if tags == [INTEGER] * 6:
        return "dsa" if version == 0 and all(_number(f) > 0 for f in fields[1:]) else ""
    secret = tags[:2] == [INTEGER, OCTET_STRING] and version == 1 and 16 <= len(fields[1][1]) <= 72
    return "ec" if secret and tags[2:] in ([], [0xA0], [0xA1], [0xA0, 0xA1]) else ""


def _wrapped(fields: list[Node]) -> bool:
    """A version, an algorithm and the key it names, in an octet string."""
    tags = _tags(fields)
    if tags[:3] != [INTEGER, SEQUENCE, OCTET_STRING] or tags[3:] not in ([], [0xA0], [0x81], [0xA1], [0xA0, 0x81], [0xA0, 0xA1]):
        return False
    algorithm, key = fields[1][2], fields[2][1]
    if _number(fields[0]) not in (0, 1) or _tags(algorithm)[:1] != [OBJECT_ID] or len(algorithm) > 2:
        return False
    name = algorithm[0][1]
    inner = parse(key)
    if name in (RSA_ENCRYPTION, EC_PUBLIC_KEY):
        named = "rsa" if name == RSA_ENCRYPTION else "ec"
        return inner is not None and _tags(inner) == [SEQUENCE] and _form(inner[0][2]) == named
    if name in CURVE_KEYS:
        return inner is not None and _tags(inner) == [OCTET_STRING] and len(inner[0][1]) in (32, 56, 57)
    return inner is not None and len(inner) == 1 and len(name) >= 3


def _sealed(fields: list[Node]) -> bool:
    """A password scheme and the key it seals."""
    if _tags(fields) != [SEQUENCE, OCTET_STRING] or len(fields[1][1]) < 32:
        return False
    scheme = fields[0][2]
    return _tags(scheme) == [OBJECT_ID, SEQUENCE] and scheme[0][1].startswith(PASSWORD_SCHEMES)


def is_private_key(data: bytes) -> bool:
    """Whether ``data`` is one DER element with the structure of a private key."""
    nodes = parse(data)
    if not nodes or _tags(nodes) != [SEQUENCE]:
        return False
    fields = nodes[0][2]
    return bool(_form(fields)) or _wrapped(fields) or _sealed(fields)


def openssh_size(data: bytes) -> int | None:
    """Bytes of the OpenSSH key file that ``data`` begins with; None unless its nested lengths fit."""
    at = len(OPENSSH_MAGIC)
    if not data.startswith(OPENSSH_MAGIC):
        return None
    strings = 3  # cipher, key derivation and its options; behind them the number of keys
    keys = 0
    while strings:
        if at + 4 > len(data):
            return None
        size = int.from_bytes(data[at : at + 4])
        at += 4 + size
        strings -= 1
        if size > _MOST_KEY or at > len(data):
            return None
        if not strings and not keys:
            keys = int.from_bytes(data[at : at + 4])
            if at + 4 > len(data) or not 1 <= keys <= 16:
                return None
            at += 4
            strings = keys + 1  # public keys and the private part
    return at if size >= 16 else None


_BREAK = re.compile(r"(?:[ \t]*(?:\r?\n|\\r\\n|\\n)[ \t]*)+")
_PIECE = {64: re.compile(r"[A-Za-z0-9+/_-]+"), 16: re.compile(r"[0-9A-Fa-f]+")}
_DER_64 = re.compile(r"M(?=[A-P][A-Za-z0-9+/_-])")
_DER_16 = re.compile(r"30(?<![0-9A-Fa-f]..)(?=[0-9A-Fa-f]{2})")
_SSH_64 = re.compile(r"b3BlbnNzaC1rZXktdjE[A-Za-z0-9+/_-]")
_SSH_16 = re.compile(r"6[fF](?<![0-9A-Fa-f]..)70656[eE]7373682[dD]6[bB]65792[dD]763100")
_TOKEN = re.compile(r"e[wy](?<![A-Za-z0-9_.-]..)[A-Za-z0-9_-]{6,}\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")  # "{", then " or a space


def gather(text: str, at: int, need: int, base: int) -> tuple[str, int] | None:
    """The next ``need`` digits from ``at`` on, across line breaks, and where they end; None where they end before."""
    parts: list[str] = []
    while need:
        piece = _PIECE[base].match(text, at, at + need)
        if piece:
            parts.append(piece[0])
            need -= len(piece[0])
            at = piece.end()
        gap = _BREAK.match(text, at) if need else None
        if need and not gap:
            return None
        at = gap.end() if gap else at
    return "".join(parts), at


def _decoded(digits: str, base: int) -> bytes | None:
    try:
        if base == 16:
            return bytes.fromhex(digits)
        if re.search("[+/]", digits) and re.search("[_-]", digits):
            return None
        return base64.b64decode(digits.translate({45: 43, 95: 47}) + "=" * (-len(digits) % 4), validate=True)
    except (ValueError, binascii.Error):
        return None


def _digits(size: int, base: int) -> int:
    return 2 * size if base == 16 else -(-4 * size // 3)


def _spans(text: str, starts: re.Pattern, base: int, confirm: Callable) -> Iterator[tuple[int, int]]:
    """Spans whose decoded bytes ``confirm`` accepts, from the left, none overlapping the one before."""
    end = 0
    for m in starts.finditer(text):
        if m.start() >= end:
            found = confirm(text, m.start(), base)
            if found:
                end = found
                yield m.start(), found


def _der_end(text: str, at: int, base: int) -> int | None:
    """Where the private key that begins at ``at`` ends, base64 padding included."""
    first = gather(text, at, 16, base)  # tag, length and the beginning of the first field
    data = first and _decoded(first[0], base)
    frame = data and header(data)
    if not frame or data[0] != SEQUENCE or data[frame[0]] not in (INTEGER, SEQUENCE):
        return None
    size = sum(frame)
    if not _LEAST_KEY <= size <= _MOST_KEY:
        return None
    whole = gather(text, at, _digits(size, base), base)
    data = whole and _decoded(whole[0], base)
    if not data or not is_private_key(data[:size]):
        return None
    return _padded(text, whole[1], -len(whole[0]) % 4 if base == 64 else 0)


def _padded(text: str, end: int, most: int) -> int:
    while most and text[end : end + 1] == "=":
        end, most = end + 1, most - 1
    return end


def _openssh_end(text: str, at: int, base: int) -> int | None:
    """Where the OpenSSH key file that begins at ``at`` ends; the fields are read as far as their lengths say."""
    need = 64
    while need <= 2 * _MOST_KEY:
        size = openssh_size(_all_digits(text, at, need, base))
        if size is not None:
            found = gather(text, at, _digits(size, base), base)
            return found and _padded(text, found[1], -len(found[0]) % 4 if base == 64 else 0)
        if gather(text, at, need, base) is None:
            return None
        need *= 4
    return None


def _all_digits(text: str, at: int, most: int, base: int) -> bytes:
    """What at most ``most`` digits from ``at`` on decode to, fewer where they end before."""
    parts: list[str] = []
    while most > 0:
        piece = _PIECE[base].match(text, at, at + most)
        if piece:
            parts.append(piece[0])
            most -= len(piece[0])
            at = piece.end()
        gap = _BREAK.match(text, at)
        if not gap:
            break
        at = gap.end()
    digits = "".join(parts)
    digits = digits[: len(digits) // 2 * 2] if base == 16 else digits[: len(digits) - (len(digits) % 4 == 1)]
    return _decoded(digits, base) or b""


def _token_end(text: str, m: re.Match) -> int | None:
    """Where a signed token ends: a JSON header that names its algorithm, a payload and a signature."""
    head, payload, signature = m[0].split(".")
    data, body, sign = _decoded(head, 64), _decoded(payload, 64), _decoded(signature, 64)
    if data is None or body is None or sign is None:
        return None
    try:
        fields = json.loads(data)
    except (ValueError, RecursionError):
        return None
    if not isinstance(fields, dict) or not isinstance(fields.get("alg"), str):
        return None
    unsigned = fields["alg"].lower() == "none"
    return m.end() if unsigned != bool(signature) else None


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind in the order of ``KINDS``, then end."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    for starts, base, kind, confirm in (
        (_DER_64, 64, 3, _der_end),
        (_DER_16, 16, 3, _der_end),
        (_SSH_64, 64, 4, _openssh_end),
        (_SSH_16, 16, 4, _openssh_end),
    ):
        out += [(a, kind, b) for a, b in _spans(text, starts, base, confirm)]
    for m in _TOKEN.finditer(text):
        end = _token_end(text, m)
        if end:
            out.append((m.start(), 5, end))
    return [(KINDS[kind], a, b) for a, kind, b in sorted(out)]


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def find_secrets(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id and ``spans`` (kind, start, end), the secrets of its whole text.

    Positions are code points, ends exclusive. Kinds: ``assign``, ``access`` and ``hex`` by pattern; ``der_key``,
    ``openssh_key`` (base64 of either alphabet or hex, also wrapped over lines) and ``signed_token`` only where the
    decoded bytes have the structure. Spans of different kinds may overlap. Nothing is shuffled.

    Defined cases: a null or empty text has no spans; one very long text is scanned whole, keys of up to 64 KiB in
    it; what decodes but does not parse is not reported; rows that repeat a doc_id are documents of their own; a
    null doc_id stays null; an empty table gives no rows; other columns are ignored.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find_spans(t.as_py() or "") for t in batch.column(1)]
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in x] for x in found]
            columns = [batch.column(0), pa.array(spans, pa.list_(_SPAN))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "spans"])

    schema = "doc_id long, spans array<struct<kind:string,start:long,end:long>>"
    rows = hide(docs, "doc_id", "text")[0]
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def secret_digests(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans as text."""
    name = "concat(s.kind, ':', s.start, ':', s.`end`)"
    base = "filter(spans, s -> s.kind IN ({}))".format(", ".join(f"'{k}'" for k in BASE_KINDS))
    counts = [F.expr(f"CAST(size(filter(spans, s -> s.kind = '{k}')) AS LONG)").alias(f"n_{k}") for k in BASE_KINDS]
    confirmed = F.expr(f"CAST(size(spans) - size({base}) AS LONG)").alias("n_confirmed")
    return found.select(
        "doc_id",
        *counts,
        F.sha2(F.expr(f"array_join(transform({base}, s -> {name}), ',')"), 256).alias("base_sha256"),
        F.expr(f"array_join(transform(spans, s -> {name}), ',')").alias("spans"),
        confirmed,
    )
