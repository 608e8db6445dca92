"""Operator 6: SentencePiece encoding and decoding by batched Viterbi in numpy.

The vocabulary and scores come from a public model file, whose path is a parameter.  A text gets a space in front; words
begin at each space that follows something else, and no piece reaches across such a place (checked when the vocabulary is
read).  Distinct words of one length advance together: all substrings are hashed, probed in the sorted hashes of the
pieces, and for each position the best sum of scores and its backpointer are taken at once.  A character that no piece
covers becomes byte pieces.  Of equal sums, the longer last piece wins.  Decoding joins the bytes of the pieces.

A long word (unspaced script, base64) is first cut where no piece of the vocabulary matches across: the best path of the
whole passes there, so its parts are words of their own and advance together with others of their length.  A part that is
still long and has few others of its length advances alone, over the matches only, block by block.

Cases: a null or empty text has no pieces and decodes to the empty text; U+2581 in a text decodes to a space, as it is the
model's mark for one (``exact`` is then false); repeated rows get equal results; extra columns are dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemill.llm.registry import query, table
from tidemill.llm.textbytes import SpanHashes, span_hash, text_slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁".encode()
UNKNOWN_PENALTY = 10.0
SLICE = 1 << 19
#: Words whose pieces a task keeps for later slices.
KEPT_WORDS = 150_000
#: Substrings probed at once.
TOGETHER = 1 << 18
#: Words of more bytes are cut where no piece crosses.
LONG = 64
#: Long parts of one length that are worth advancing together.
MANY = 32
#: Positions whose matches a part that advances alone holds at once.
BLOCK = 1 << 15


@dataclass
class Vocabulary:
    """Pieces by sorted hash; a few megabytes."""

    hashes: np.ndarray
    ids: np.ndarray
    scores: np.ndarray
    lengths: np.ndarray  # of pieces in bytes, longest first
    filter: np.ndarray  # which low bits of a hash occur
    byte_ids: np.ndarray
    unknown: float
    places: np.ndarray  # of each id's bytes
    data: np.ndarray
    by_length: dict[int, int]

    def probe(self, hashes: np.ndarray) -> np.ndarray:
        """Index of each hash among the pieces, or -1."""
        out = np.full(hashes.shape, -1, np.int32)
        flat, maybe = out.reshape(-1), np.flatnonzero(self.filter[(hashes & np.uint64(len(self.filter) - 1)).astype(np.int64)])
        wanted = hashes.reshape(-1)[maybe]
        at = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
        good = self.hashes[at] == wanted
        flat[maybe[good]] = at[good]
        return out


def read_vocabulary(path: str = MODEL) -> Vocabulary:
    """Pieces and scores of a model file; raises if a piece reaches across the start of a word."""
    from sentencepiece import sentencepiece_model_pb2 as messages

    model = messages.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    kinds = messages.ModelProto.SentencePiece
    keys, ids, scores, raw, byte_ids = [], [], [], [], np.full(256, -1, np.int32)
    for k, piece in enumerate(model.pieces):
        own = b""
        if piece.type == kinds.BYTE:
            own = bytes([int(piece.piece[3:5], 16)])
            byte_ids[own[0]] = k
        elif piece.type in (kinds.NORMAL, kinds.USER_DEFINED):
            own = piece.piece.encode().replace(MARK, b" ")
            if b" " in own.lstrip(b" "):
                raise ValueError(f"piece {k} holds a space behind other characters")
            keys.append(span_hash(own))
            ids.append(k)
            scores.append(piece.score)
        raw.append(own)
    if (byte_ids < 0).any():
        raise ValueError("the model has no byte pieces")
    order = np.argsort(np.array(keys, np.uint64))
    hashes = np.array(keys, np.uint64)[order]
    filter_ = np.zeros(1 << 18, bool)
    filter_[(hashes & np.uint64(len(filter_) - 1)).astype(np.int64)] = True
    lengths = np.array(sorted({len(raw[k]) for k in ids}, reverse=True))
    places = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    return Vocabulary(hashes, np.array(ids, np.int32)[order], np.array(scores)[order], lengths, filter_, byte_ids, min(scores) - UNKNOWN_PENALTY, places, np.frombuffer(b"".join(raw), np.uint8), {int(x): k for k, x in enumerate(lengths)})


def _viterbi(vocabulary: Vocabulary, data: np.ndarray, spans: SpanHashes, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words of ``size`` bytes (right-aligned, n x size) and how many each has."""
    n = len(starts)
    lengths = vocabulary.lengths[vocabulary.lengths <= size]
    scores = np.concatenate([vocabulary.scores, [-np.inf]])
    best = np.full((n, size + 1), -np.inf)
    best[:, 0] = 0
    back = np.zeros((n, size + 1), np.int32)
    step_id = np.zeros((n, size + 1), np.int32)
    codes = data[starts[:, None] + np.arange(size)]
    single = np.where((codes & 0xC0) == 0x80, 0.0, vocabulary.unknown)
    rows = np.arange(n)
    span = max(1, TOGETHER // max(1, n * len(lengths)))
    for low in range(1, size + 1, span):
        ends = np.arange(low, min(low + span, size + 1))
        begin = ends[:, None] - lengths[None, :]
        able = begin >= 0
        found = np.full((n, len(ends), len(lengths)), -1, np.int32)
        e, k = np.nonzero(able)
        a = starts[:, None] + begin[e, k]
        found[:, e, k] = vocabulary.probe(spans.of(a, starts[:, None] + ends[e]))
        value = scores[found]
        for x, end in enumerate(ends):
            sums = value[:, x] + best[:, np.maximum(begin[x], 0)]
            pick = sums.argmax(axis=1)
            top = sums[rows, pick]
            alone = best[:, end - 1] + single[:, end - 1]
            whole = top >= alone
            best[:, end] = np.where(whole, top, alone)
            back[:, end] = np.where(whole, lengths[pick], 1)
            step_id[:, end] = np.where(whole, vocabulary.ids[found[rows, x, pick]], vocabulary.byte_ids[codes[:, end - 1]])
    out, count, at = np.zeros((n, size), np.int32), np.zeros(n, np.int64), np.full(n, size)
    going = rows
    while len(going):
        count[going] += 1
        out[going, size - count[going]] = step_id[going, at[going]]
        at[going] -= back[going, at[going]]
        going = going[at[going] > 0]
    return out, count


def _matches(vocabulary: Vocabulary, spans: SpanHashes, positions: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins (as indices of ``positions``), lengths and piece indices of all pieces that begin there and end by the limits."""
    at, sizes, pieces = [], [], []
    for length in vocabulary.lengths:
        able = np.flatnonzero(positions + length <= limits)
        found = vocabulary.probe(spans.of(positions[able], positions[able] + length))
        hit = np.flatnonzero(found >= 0)
        at.append(able[hit])
        sizes.append(np.full(len(hit), length, np.int64))
        pieces.append(found[hit])
    return np.concatenate(at), np.concatenate(sizes), np.concatenate(pieces)


def _cuts(vocabulary: Vocabulary, spans: SpanHashes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places inside the given words that no matching piece crosses."""
    sizes = ends - starts
    edges = np.concatenate([[0], np.cumsum(sizes)])
    shift = np.repeat(starts - edges[:-1], sizes)
    crossing = np.zeros(edges[-1] + 1, np.int32)  # changes of the number of pieces across a place
    for low in range(0, len(shift), TOGETHER):
        own = np.arange(low, min(low + TOGETHER, len(shift)))
        at, length, _ = _matches(vocabulary, spans, own + shift[own], np.repeat(ends, sizes)[own])
        np.add.at(crossing, low + at + 1, 1)
        np.add.at(crossing, low + at + length, -1)
    free = np.cumsum(crossing)[:-1] == 0
    free[edges[:-1]] = False  # the words' own starts
    free = np.flatnonzero(free)
    return free + shift[free]


def _advance_alone(vocabulary: Vocabulary, data: np.ndarray, spans: SpanHashes, start: int, size: int) -> np.ndarray:
    """Ids of one long word: sums are carried forward over the matches, in the order of their begins."""
    back, step_id = np.zeros(size + 1, np.int32), np.zeros(size + 1, np.int32)
    reach = int(vocabulary.lengths[0])
    best, came, chosen = [0.0] + [-np.inf] * reach, [0] * (reach + 1), [0] * (reach + 1)
    for low in range(0, size, BLOCK):
        n = min(BLOCK, size - low)
        positions = np.arange(start + low, start + low + n)
        at, length, piece = _matches(vocabulary, spans, positions, np.full(n, start + size))
        order = np.argsort(at, kind="stable")
        first = np.searchsorted(at[order], np.arange(n + 1)).tolist()
        steps, ids, worth = length[order].tolist(), vocabulary.ids[piece[order]].tolist(), vocabulary.scores[piece[order]].tolist()
        code = data[positions]
        alone, alone_id = np.where((code & 0xC0) == 0x80, 0.0, vocabulary.unknown).tolist(), vocabulary.byte_ids[code].tolist()
        best, came, chosen = best + [-np.inf] * n, came + [0] * n, chosen + [0] * n
        # an earlier begin is a longer last piece, and keeps its place against an equal sum
        for here in range(n):
            so_far = best[here]
            for k in range(first[here], first[here + 1]):
                end, total = here + steps[k], so_far + worth[k]
                if total > best[end]:
                    best[end], came[end], chosen[end] = total, steps[k], ids[k]
            total = so_far + alone[here]
            if total > best[here + 1]:
                best[here + 1], came[here + 1], chosen[here + 1] = total, 1, alone_id[here]
        back[low + 1 : low + n + 1], step_id[low + 1 : low + n + 1] = came[1 : n + 1], chosen[1 : n + 1]
        best, came, chosen = best[n:], came[n:], chosen[n:]
    lengths, places, at = back.tolist(), [], size
    while at > 0:
        places.append(at)
        at -= lengths[at]
    return step_id[places[::-1]]


def _ragged(places: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Indices of the elements of the chosen lists, one after another."""
    low, size = places[chosen], places[chosen + 1] - places[chosen]
    total = np.cumsum(size)
    return np.arange(total[-1] if len(total) else 0) - np.repeat(total - size - low, size)


class Encoder:
    """Encodes and decodes slices; remembers the pieces of words it has met, up to a bound."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.known, self.places, self.pieces = np.empty(0, np.uint64), np.zeros(1, np.int64), np.empty(0, np.int32)
        self.slots = np.empty(0, np.int64)

    def _forget(self) -> None:
        """Drop the half of the kept words that came first."""
        half = (len(self.places) - 1) // 2
        late = self.slots >= half
        self.known, self.slots = self.known[late], self.slots[late] - half
        self.pieces, self.places = self.pieces[self.places[half] :].copy(), self.places[half:] - self.places[half]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the n + 1 offsets into them."""
        n = len(offsets) - 1
        raw = data.tobytes()
        if MARK in raw:
            texts = [raw[a:b].replace(MARK, b" ") for a, b in zip(offsets[:-1], offsets[1:])]
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
            data = np.frombuffer(b"".join(texts), np.uint8)
        full = offsets[1:] > offsets[:-1]
        extra = np.concatenate([[0], np.cumsum(full)])
        edges = offsets + extra
        spaced = np.full(edges[-1], 32, np.uint8)
        keep = np.ones(edges[-1], bool)
        keep[edges[:-1][full]] = False
        spaced[keep] = data
        space = spaced == 32
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins[edges[:-1][full]] = True
        starts = np.flatnonzero(begins)
        ends = np.concatenate([starts[1:], [len(spaced)]]) if len(starts) else starts
        spans = SpanHashes(spaced)
        long = ends - starts > LONG
        if long.any():
            starts = np.sort(np.concatenate([starts, _cuts(self.vocabulary, spans, starts[long], ends[long])]))
            ends = np.concatenate([starts[1:], [len(spaced)]])
        unique, first, inverse = np.unique(spans.of(starts, ends), return_index=True, return_inverse=True)
        slot = self._slots(unique, spaced, spans, starts[first], ends[first])
        per_word = slot[inverse]
        ids = self.pieces[_ragged(self.places, per_word)]
        sizes = np.concatenate([[0], np.cumsum(self.places[per_word + 1] - self.places[per_word])])
        return ids, sizes[np.searchsorted(starts, edges)]

    def _slots(self, hashes, data, spans, starts, ends) -> np.ndarray:
        """Where the pieces of each word are kept, after those of new words have been found."""
        if len(self.known) > KEPT_WORDS:
            self._forget()
        at = np.minimum(np.searchsorted(self.known, hashes), max(len(self.known) - 1, 0))
        new = self.known[at] != hashes if len(self.known) else np.ones(len(hashes), bool)
        todo = np.flatnonzero(new)
        if len(todo):
            sizes = (ends - starts)[todo]
            order = np.argsort(sizes, kind="stable")
            todo, sizes = todo[order], sizes[order]
            cuts = np.flatnonzero(np.diff(sizes)) + 1
            parts, counts = [], []
            for own in np.split(todo, cuts):
                size = int(ends[own[0]] - starts[own[0]])
                if size > LONG and len(own) < MANY:
                    for start in starts[own]:
                        parts.append(_advance_alone(self.vocabulary, data, spans, int(start), size))
                        counts.append([len(parts[-1])])
                    continue
                step = max(1, TOGETHER // (4 * size))
                for low in range(0, len(own), step):
                    found, count = _viterbi(self.vocabulary, data, spans, starts[own[low : low + step]], size)
                    parts.append(found[np.arange(size)[None, :] >= size - count[:, None]])
                    counts.append(count)
            base = len(self.places) - 1
            self.places = np.concatenate([self.places, self.places[-1] + np.cumsum(np.concatenate(counts))])
            self.pieces = np.concatenate([self.pieces, *parts])
            merged, slots = np.concatenate([self.known, hashes[todo]]), np.concatenate([self.slots, base + np.arange(len(todo))])
            order = np.argsort(merged, kind="stable")
            self.known, self.slots = merged[order], slots[order]
        return self.slots[np.searchsorted(self.known, hashes)]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts, and the n + 1 offsets; the space in front is taken off."""
        v = self.vocabulary
        size = np.concatenate([[0], np.cumsum(v.places[ids + 1] - v.places[ids])]) if len(ids) else np.zeros(1, np.int64)
        data, edges = v.data[_ragged(v.places, ids)], size[offsets]
        full = offsets[1:] > offsets[:-1]
        keep = np.ones(len(data), bool)
        keep[edges[:-1][full]] = False
        return data[keep], edges - np.concatenate([[0], np.cumsum(full)])


def encode_documents(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id, n_pieces, ids, decoded_crc32, exact`` of every row: the ids, and what decoding them gives.

    ``decoded_crc32`` is the checksum of the decoded text, ``exact`` tells whether it equals the text.
    """
    from zlib import crc32

    vocabulary = read_vocabulary(model)

    def batches(stream):
        encoder = Encoder(vocabulary)
        for batch in stream:
            for own, data, offsets in text_slices(batch, limit=SLICE):
                ids, places = encoder.encode(data, offsets)
                decoded, edges = encoder.decode(ids, places)
                back = [decoded[a:b] for a, b in zip(edges[:-1], edges[1:])]
                same = [len(x) == b - a and bool((x == data[a:b]).all()) for x, a, b in zip(back, offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [own.column("doc_id"), pa.array(np.diff(places)), pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), pa.array(ids)), pa.array([crc32(x) for x in back], pa.int64()), pa.array(same)],
                    ["doc_id", "n_pieces", "ids", "decoded_crc32", "exact"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(batches, "doc_id long, n_pieces long, ids array<int>, decoded_crc32 long, exact boolean")


def decode_documents(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids give the empty text."""
    vocabulary = read_vocabulary(model)

    def batches(stream):
        encoder = Encoder(vocabulary)
        for batch in stream:
            lists = batch.column("ids")
            sizes = np.asarray(lists.value_lengths().fill_null(0))
            data, edges = encoder.decode(np.asarray(lists.flatten()), np.concatenate([[0], np.cumsum(sizes)]))
            texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(edges[:-1], edges[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(batches, "doc_id long, text string")


@query("op6_pieces")
def op6_pieces(spark, sf_dir):
    return encode_documents(table(spark, sf_dir, "documents"))
