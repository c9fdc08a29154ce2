"""Plain loops that the operators are held against, and small tables with awkward rows."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
_WORDS = "the of and quick brown fox jumps over lazy dog lorem ipsum dolor sit amet consetetur elitr sed diam".split()


def prose(seed, words):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(_WORDS, words)) + "."


def awkward_docs(spark, extra=False):
    """Nulls in every column, empty and long texts, ties, repeated rows and, if asked for, clashing columns."""
    shared = prose(1, 120)
    texts = [
        None, "", " \n\t ", "one", "one two", shared, shared, shared + " tail " + prose(2, 40), prose(3, 90) + shared,
        prose(4, 6000), "é" * 900, "a" * 1500, "日本語 " * 300, "<|endoftext|> x <|im_end|>", prose(5, 50), "x\x1cy  z\u0085w",
    ]
    rows = [(i, t, ["en", None, "fr"][i % 3], ["a", "b", None][i % 3], len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], rows[9], (None, shared, None, None, None), (None, None, None, None, None), (3, "other text", "en", "a", 1)]
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        for c in ("score", "predicted", "_fp", "topic", "kept", "first", "state", "start", "content", "_text_key"):
            df = df.selectExpr("*", f"'x' AS {c}")
    return df


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


_TOKENIZERS = {}


def tokens(text, file="word_bpe_49k.json"):
    if file not in _TOKENIZERS:
        _TOKENIZERS[file] = Tokenizer.from_file(public_tokenizers.path(file))
    return _TOKENIZERS[file].encode(text or "", add_special_tokens=False).ids


def ids_crc32(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(pairs, nodes):
    """The smallest node reachable from each."""
    neighbours = defaultdict(set)
    for a, b in pairs:
        neighbours[a].add(b)
        neighbours[b].add(a)
    out = {}
    for n in sorted(nodes):
        stack = [n]
        while stack:
            x = stack.pop()
            if x not in out:
                out[x] = n
                stack += neighbours[x]
    return out


def removed(texts, length, keep_first=False):
    """For each text its bytes that stay and the number of spans, given texts in order."""
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    seen, out = set(), []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            s = d[i : i + length]
            if s in seen if keep_first else count[s] > 1:
                gone[i : i + length] = b"\1" * length
            seen.add(s)
        spans = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        out.append((bytes(c for c, x in zip(d, gone) if not x), spans))
    return out


def sha(data):
    return hashlib.sha256(data).hexdigest()
