"""SentencePiece encoding and decoding with a batched Viterbi in numpy.

A text's spaces become U+2581 and one is put before it; it is cut into units
where no piece can reach across: before a space run and around characters that
stand in no longer piece.  Every distinct unit of a block is segmented once.
Substrings up to the longest piece are hashed, as long as a piece may begin so, and looked up in the sorted piece keys
by their leading bits; then all units advance together, a character at
a time, a maximum over the pieces that end there storing the backpointer.
Of equal sums the longest last piece wins.  A character without a piece becomes its UTF-8
bytes' pieces, at a score under all pieces; U+2581 itself is always written as
bytes, so that decoding gives exactly the text that was encoded.

The segmentation has the largest sum of the model's piece scores.  For a model
trained as unigram that is SentencePiece's own; the scores of a BPE model are
its merge ranks, where merging greedily may segment otherwise.

Defined cases: a null or empty text has no ids; a model without byte pieces writes its unknown
id, which decodes to U+2047 between spaces; texts of any length are taken whole; repeated
rows get equal results; an empty table gives an empty result.  Only the named
columns are read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from martflow.llm.flat import Block, map_texts, ragged

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = 0x2581
#: Stands for U+2581 in a text, so that no piece matches it.
_LITERAL = 0x110000
#: How far under the least piece score a character without a piece scores.
PENALTY = 10.0
#: Leading bits of a hash by which most substrings are told from pieces and their beginnings, and pieces found.
_LIKELY_BITS = 20


class Pieces(NamedTuple):
    """A model as arrays: piece hashes in order with ids, scores by id (and minus infinity at the end), which leading hash
    bits occur, from which place on and in the beginnings of longer pieces, the ids of bytes, the cutting rules, and each id's UTF-8 text."""

    keys: np.ndarray
    ids: np.ndarray
    scores: np.ndarray
    likely: np.ndarray
    slot: np.ndarray
    goes_on: np.ndarray
    longest: int
    byte_ids: np.ndarray
    unknown: int
    joined: np.ndarray
    cut_at_space: bool
    raw: np.ndarray
    raw_begin: np.ndarray
    raw_length: np.ndarray


def load(path: str = MODEL) -> Pieces:
    """Read a SentencePiece model file: ordinary pieces, byte pieces and the unknown id."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    text = [model.id_to_piece(i) for i in range(n)]
    plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    block = Block([text[i] for i in plain])
    keys = block.hashes(block.begin, block.end)
    order = np.argsort(keys)
    scores = np.array([model.get_score(i) for i in range(n)] + [-np.inf])
    likely = np.zeros(1 << _LIKELY_BITS, bool)
    likely[keys >> np.uint64(64 - _LIKELY_BITS)] = True
    slot = np.searchsorted(keys[order], np.arange(1 << _LIKELY_BITS, dtype=np.uint64) << np.uint64(64 - _LIKELY_BITS)).astype(np.int32)
    slot[~likely] = 0
    size = block.end - block.begin
    parts = np.repeat(block.begin, size - 1)
    goes_on = np.zeros(1 << _LIKELY_BITS, bool)
    goes_on[block.hashes(parts, parts + ragged(np.ones(len(size), np.int64), size - 1)) >> np.uint64(64 - _LIKELY_BITS)] = True
    byte_ids = np.full(256, -1)
    raw = [b""] * n
    for i in range(n):
        if model.is_byte(i):
            byte_ids[int(text[i][3:5], 16)] = i
            raw[i] = bytes([int(text[i][3:5], 16)])
    for i in plain:
        raw[i] = text[i].replace("▁", " ").encode()
    raw[model.unk_id()] = " ⁇ ".encode()
    length = np.array([len(x) for x in raw])
    joined = np.unique(np.array([ord(c) for i in plain if len(text[i]) > 1 for c in text[i]], np.uint32))
    return Pieces(keys[order], np.array(plain)[order], scores, likely, slot, goes_on, max(len(text[i]) for i in plain), byte_ids, model.unk_id(), joined,
                  not any("▁" in text[i].lstrip("▁") for i in plain), np.frombuffer(b"".join(raw), np.uint8), np.cumsum(length) - length, length)


def _units(block: Block, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the parts that are segmented on their own."""
    cp = block.cp
    inside = np.ones(len(cp), bool)
    inside[block.end] = False
    alone = ~np.isin(cp, pieces.joined)
    edge = np.zeros(len(cp) + 1, bool)
    edge[0] = edge[-1] = True
    edge[1:-1] = (inside[1:] != inside[:-1]) | alone[1:] | alone[:-1]
    if pieces.cut_at_space:
        edge[1:-1] |= (cp[1:] == SPACE) & (cp[:-1] != SPACE)
    edge[:-1][block.begin[block.end > block.begin]] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    real = inside[starts]
    return starts[real], ends[real]


def _find(pieces: Pieces, h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The id of the piece of each hash, -1 for none; ``bits`` are its leading bits, which a piece's hash has too."""
    place = pieces.slot[bits]
    out = np.full(len(h), -1, np.int32)
    rest = np.arange(len(h))
    while len(rest):
        hit = pieces.keys[place] == h
        out[rest[hit]] = pieces.ids[place[hit]]
        # on to the next piece where its hash has the same leading bits
        more = np.flatnonzero(~hit & (place + 1 < len(pieces.keys)))
        more = more[pieces.keys[place[more] + 1] >> np.uint64(64 - _LIKELY_BITS) == bits[more]]
        rest, place, h, bits = rest[more], place[more] + 1, h[more], bits[more]
    return out


def viterbi(block: Block, starts: np.ndarray, ends: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit, start, id) of the best pieces of each unit, in order; id -1 for a character without a piece."""
    n = ends - starts
    first = np.cumsum(n) - n
    at, stop = ragged(starts, n), np.repeat(ends, n)
    reach = int(min(pieces.longest, n.max()))
    # characters are ranked by their place in the unit; before the first of a unit is the rank past all
    place = np.arange(len(at)) - np.repeat(first, n)
    order = np.argsort(place.astype(np.uint16) if n.max() <= 1 << 16 else place, kind="stable")
    rank = np.empty(len(at), np.int64)
    rank[order] = np.arange(len(at))
    # row: a character that a piece ends with; column: the piece's length, the longest first
    ids = np.full((len(at), reach), -1, np.int32)
    live = np.arange(len(at))
    for k in range(1, reach + 1):
        live = live[at[live] + k <= stop[live]]
        h = block.hashes(at[live], at[live] + k)
        bits = h >> np.uint64(64 - _LIKELY_BITS)
        one = np.flatnonzero(pieces.likely[bits])
        found = _find(pieces, h[one], bits[one])
        hit = found >= 0
        ids[rank[live[one[hit]] + k - 1], reach - k] = found[hit]
        live = live[pieces.goes_on[bits]]
    none = len(pieces.scores) - 1  # stands for a character without a piece
    ids[ids[:, -1] < 0, -1] = none
    edge = np.flatnonzero(ids.ravel() >= 0)
    ids = ids.ravel()[edge]
    row, length = edge // reach, reach - edge % reach
    score = np.append(pieces.scores[:-1], pieces.scores[:-1].min() - PENALTY)[ids]
    came = np.where(length <= place[order[row]], rank[order[row] - length], len(at))
    begin = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(at)))))
    cut = np.searchsorted(place[order], np.arange(int(n.max()) + 1)).tolist()
    best, back = np.zeros(len(at) + 1), np.empty(len(at), np.int64)
    bounds = begin[cut].tolist()
    for low, high, a, b in zip(cut, cut[1:], bounds, bounds[1:]):
        total = best[came[a:b]] + score[a:b]
        best[low:high] = np.maximum.reduceat(total, begin[low:high] - a)
        top = np.flatnonzero(total == best[row[a:b]])[::-1] + a
        back[row[top]] = top  # of equal sums the first, written last, stays
    chosen = np.full(len(at), -1)
    now = rank[first + n - 1]
    while len(now):
        by = back[now]
        chosen[order[now]] = by
        now = came[by]
        now = now[now < len(at)]
    last = np.flatnonzero(chosen >= 0)
    by = chosen[last]
    found = ids[by]
    return np.repeat(np.arange(len(n)), n)[last], at[last] - length[by] + 1, np.where(found < none, found, -1)


def _utf8(cp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of code points in rows of four, and how many each has."""
    cp = cp.astype(np.int64)
    n = 1 + (cp >= 0x80) + (cp >= 0x800) + (cp >= 0x10000)
    out = np.zeros((len(cp), 4), np.int64)
    lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])
    for k in (1, 2, 3, 4):
        own = n == k
        for i in range(k):
            part = cp[own] >> (6 * (k - 1 - i))
            out[own, i] = (part | lead[k]) if i == 0 else (part & 0x3F) | 0x80
    return out, n


def encode_block(texts: list, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts end to end, and where each text's begin (one more at the end)."""
    block = Block([f" {t}" if t else "" for t in texts])
    cp = block.cp.copy()
    cp[cp == SPACE] = _LITERAL
    cp[cp == 32] = SPACE
    block.rehash(cp)
    starts, ends = _units(block, pieces)
    if not len(starts):
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    h = block.hashes(starts, ends)
    _, one, number = np.unique(h, return_index=True, return_inverse=True)
    n = ends - starts
    same = n[one][number] == n
    if not (same.all() and np.array_equal(cp[ragged(starts, n)], cp[ragged(starts[one][number], n)])):
        one = number = np.arange(len(starts))  # two units share a hash: segment each on its own
    unit, where, ids = viterbi(block, starts[one], ends[one], pieces)

    lost = ids < 0
    width = np.ones(len(ids), np.int64)
    if lost.any():
        code = cp[where[lost]]
        raw, size = _utf8(np.where(code == _LITERAL, SPACE, code))
        as_bytes = (pieces.byte_ids[raw] >= 0).all(1)
        width[lost] = np.where(as_bytes, size, 1)
        row = np.repeat(np.arange(len(ids)), width)
        step = np.arange(len(row)) - np.repeat(np.cumsum(width) - width, width)
        wide = ids[row]
        spot = np.cumsum(lost)[row] - 1
        filled = np.where(as_bytes[spot], pieces.byte_ids[raw[spot, step]], pieces.unknown)
        ids, unit = np.where(lost[row], filled, wide), unit[row]
    per = np.bincount(unit, minlength=len(one))
    begin = np.cumsum(per) - per
    flat = ids[ragged(begin[number], per[number])].astype(np.int32)
    tokens = np.bincount(block.owner(starts), weights=per[number], minlength=len(texts)).astype(np.int64)
    return flat, np.concatenate(([0], np.cumsum(tokens)))


def decode_block(ids: np.ndarray, begin: np.ndarray, pieces: Pieces) -> list[bytes]:
    """The UTF-8 text of each run of ids; the space put before a text goes."""
    n = pieces.raw_length[ids]
    flat = pieces.raw[ragged(pieces.raw_begin[ids], n)].tobytes()
    at = np.concatenate(([0], np.cumsum(n)))[begin]
    return [flat[a + (b > a and flat[a] == 32):b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def encode(docs: DataFrame, doc: str = "doc_id", text: str = "text", model: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, ids and exact (whether decoding gives the text back) of every row of ``docs``."""
    pieces = load(model)
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("exact", T.BooleanType())]

    def make():
        def work(texts):
            ids, begin = encode_block(texts, pieces)
            exact = [got == (t or "").encode() for got, t in zip(decode_block(ids, begin, pieces), texts)]
            return [pa.array(np.diff(begin)), pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(ids)), pa.array(exact)]

        return work

    return map_texts(docs.select(docs[f"`{doc}`"].alias("doc_id"), docs[f"`{text}`"].alias("t")), make, fields, "t", ["doc_id"])


def decode(tokens: DataFrame, doc: str = "doc_id", ids: str = "ids", model: str = MODEL) -> DataFrame:
    """doc_id and text of every row of (doc_id, ids); null ids give an empty text."""
    from pyspark.sql import functions as F

    from martflow.llm.staging import ship_package

    ship_package(tokens.sparkSession)
    pieces = load(model)

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            flat, n = lists.flatten().to_numpy(), np.array([len(x) if x is not None else 0 for x in lists.to_pylist()], np.int64)
            texts = decode_block(flat, np.concatenate(([0], np.cumsum(n))), pieces)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t.decode(errors="replace") for t in texts], pa.string())], ["doc_id", "text"])

    source = tokens.select(F.col(doc).alias("doc_id"), F.col(ids).cast("array<int>").alias("ids"))
    return source.mapInArrow(run, T.StructType([T.StructField("doc_id", source.schema["doc_id"].dataType), T.StructField("text", T.StringType())]))
