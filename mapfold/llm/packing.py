"""Order-preserving packing of documents into fixed token windows.

Documents of a partition form one token stream in row order (``order_by`` asks
for a range sort first; without it the table's own order stays and nothing is
shuffled).  A window may be cut at a document end (free), at a sentence end
(``split_penalty``) or, inside a sentence longer than a window, every
``length // 8`` tokens (``inside_penalty``).  With key(j) = cost(j) + place(j),

    cost(i) = penalty(i) + length - place(i) + min { key(j) : place(i) - place(j) <= length }

so the best cut before i is the head of a monotone queue of keys, and the whole
stream is solved in linear time.  The stream is solved in stretches of about
``stretch`` tokens that end at a document end, which bounds memory; one padded
window per stretch is the price.

Defined cases: null and empty texts are one token (the document end); very long
texts are split over windows; repeated rows are packed like any other; an empty
table gives no pieces; further columns of the input are ignored.
"""

from __future__ import annotations

import base64
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapfold.llm.common import distinct, ship, table

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

_ENCODERS: dict[str, tuple] = {}

#: the pattern's \s spelled out, in runs that are cut out before its look-ahead has to back up through them
_BLANK = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
LONG_BLANKS = re.compile(f"(?<!{_BLANK}){_BLANK}{{65536,}}")


def encoder(vocabulary: str):
    """(encode to a numpy array; flags of sentence ends, clause ends, blank starts, line starts) of a
    byte-level vocabulary file; ``vocabulary`` is a file name of the installed public
    tokenizers or a path.  Texts are split at the added tokens of the JSON file of the same name
    (if there is one), which become their own ids, as ``tokenizers`` has it by default."""
    if vocabulary not in _ENCODERS:
        import public_tokenizers
        import tiktoken

        path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        enc = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        beside = path.removesuffix(".tiktoken") + ".json"
        added: dict[str, int] = {}
        if os.path.exists(beside):
            with open(beside, encoding="utf-8") as f:
                for t in json.load(f)["added_tokens"]:
                    if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]:
                        raise ValueError(f"added token {t['content']!r} of {beside} is not matched literally")
                    added[t["content"]] = t["id"]
        marks = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        n = max([*ranks.values(), *added.values()]) + 1
        ends, clause, blank, line = (np.zeros(n, bool) for _ in range(4))
        for b, i in ranks.items():
            ends[i] = b[-1:] in (b".", b"!", b"?") or b[-2:] in (b'."', b'!"', b'?"', b".)", b"!)", b"?)")
            clause[i] = b[-1:] in (b",", b";", b":")
            blank[i] = b[:1] in (b" ", b"\t", b"\n", b"\r")
            line[i] = b[:1] in (b"\n", b"\r")

        def encode(text: str) -> np.ndarray:
            """Ids of a text, added tokens included."""
            if marks is None or not any(t in text for t in added):
                return plain(text)
            parts, at = [], 0
            for m in marks.finditer(text):
                parts += [plain(text[at : m.start()]), [added[m[0]]]]
                at = m.end()
            parts.append(plain(text[at:]))
            return np.concatenate([np.asarray(p, np.uint32) for p in parts])

        def plain(text: str) -> np.ndarray:
            """Ids of a text without added tokens.  The pattern makes one piece of a run of blanks at the text's end, and
            of all but the last blank of any other run; what follows starts with that blank."""
            parts, at = [], 0
            for m in LONG_BLANKS.finditer(text) if len(text) >= 1 << 16 else ():
                last = m.end() - (m.end() < len(text))
                parts += [enc.encode_to_numpy(text[at : m.start()]), enc._encode_single_piece(text[m.start() : last])]
                at = last
            parts.append(enc.encode_to_numpy(text[at:]))
            return np.concatenate([np.asarray(p, np.uint32) for p in parts]) if parts[1:] else parts[0]

        _ENCODERS[vocabulary] = (encode, ends, clause, blank, line)
    return _ENCODERS[vocabulary]


def cuts(places: np.ndarray, penalty: np.ndarray, length: int) -> list[int]:
    """Indices of the chosen cut places, first and last included.

    ``places`` rise from 0 with gaps of at most ``length``; minimises the sum
    over windows of padding plus the penalty of the window's end."""
    pos, pen = places.tolist(), penalty.tolist()
    m = len(pos)
    key, back, queue, head = [0] * m, [0] * m, [0], 0
    for i in range(1, m):
        least = pos[i] - length
        while pos[queue[head]] < least:
            head += 1
        j = queue[head]
        back[i] = j
        k = key[i] = key[j] + pen[i] + length
        while len(queue) > head and key[queue[-1]] > k:
            queue.pop()
        queue.append(i)
    out, i = [m - 1], m - 1
    while i:
        i = back[i]
        out.append(i)
    return out[::-1]


def candidates(ids: np.ndarray, doc_ends: np.ndarray, flags, length: int, split_penalty: int, clause_penalty: int, inside_penalty: int) -> tuple[np.ndarray, np.ndarray]:
    """Cut places of one stretch and the penalty of each."""
    _, ends, clause, blank, line = flags
    n = len(ids)
    pen = np.full(n + 1, -1, np.int64)
    pen[np.flatnonzero(clause[ids[:-1]] & blank[ids[1:]]) + 1] = clause_penalty
    after = np.flatnonzero((ends[ids[:-1]] & blank[ids[1:]]) | line[ids[1:]]) + 1
    pen[after] = split_penalty
    pen[doc_ends - 1] = -1  # never cut the end token off its document
    pen[0] = 0
    pen[doc_ends] = 0
    at = np.flatnonzero(pen >= 0)
    gap = np.diff(at)
    wide = np.flatnonzero(gap > length)
    if len(wide):
        step = max(1, length // 8)
        for w in wide:
            more = np.arange(at[w] + step, at[w + 1], step)
            pen[more] = inside_penalty
        at = np.flatnonzero(pen >= 0)
    return at, pen[at]


def pack(
    docs: DataFrame,
    length: int = 2048,
    vocabulary: str = "byte_bpe_50k.tiktoken",
    end_id: int = 1,
    split_penalty: int = 8,
    clause_penalty: int = 24,
    inside_penalty: int = 256,
    stretch: int = 1 << 21,
    order_by: list[str] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents: ``ids`` are little-endian unsigned 32-bit token
    ids; (sequence_id, offset) is the place in the packed output."""
    ship(docs.sparkSession)
    if order_by:
        docs = docs.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def solve(keys: list, toks: list[np.ndarray], sequence: int) -> tuple[pa.RecordBatch, int]:
        counts = np.fromiter((len(t) for t in toks), np.int64, len(toks))
        ids = np.concatenate(toks)
        doc_ends = np.cumsum(counts)
        at, pen = candidates(ids, doc_ends, encoder(vocabulary), length, split_penalty, clause_penalty, inside_penalty)
        window = at[cuts(at, pen, length)]
        edges = distinct(np.concatenate([window, [0], doc_ends]))
        first, size = edges[:-1], np.diff(edges)
        doc = np.searchsorted(doc_ends, first, side="right")
        win = np.searchsorted(window, first, side="right") - 1
        data = pa.py_buffer(np.ascontiguousarray(ids, np.uint32).astype("<u4", copy=False).tobytes())
        cols = [
            pa.array(keys, pa.int64()).take(pa.array(doc)),
            pa.array(first - (doc_ends - counts)[doc]),
            pa.array(size),
            pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer((edges * 4).astype(np.int32)), data]),
            pa.array(counts[doc]),
            pa.array(win + sequence),
            pa.array(first - window[win]),
        ]
        names = [c.split()[0] for c in PIECES.split(", ")]
        return pa.RecordBatch.from_arrays(cols, names=names), sequence + len(window) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 40
        encode = encoder(vocabulary)[0]
        keys, toks, held = [], [], 0
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys.append(key)
                toks.append(np.concatenate([encode(text), end]) if text else end)
                held += len(toks[-1])
                if held >= stretch:
                    out, sequence = solve(keys, toks, sequence)
                    keys, toks, held = [], [], 0
                    yield from parts(out)
        if toks:
            out, _ = solve(keys, toks, sequence)
            yield from parts(out)

    def parts(out: pa.RecordBatch, rows: int = 4096) -> Iterator[pa.RecordBatch]:
        return (out.slice(i, rows) for i in range(0, out.num_rows, rows))

    return docs.mapInArrow(run, PIECES)


def op2_packing(spark, sf_dir: str) -> DataFrame:
    """Every document packed into 2048-token windows; one row per piece."""
    pieces = pack(table(spark, sf_dir, "documents"))
    return digest(pieces)


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
