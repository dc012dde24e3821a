"""Language-model scores by logistic context mixing over decisions and bits of whole texts.

A text is coded token by token, and each token in up to three binary decisions: is it drawn
from the words that followed the last two words in training; if not, from those that
followed the last one; if not, from all words of the training text. A word drawn in a
context costs its share of that context; a new word is spelled bit by bit, its bytes being
ways down a Huffman tree and a blank its end (the end of a text is a token of its own).

Every decision and every spelled bit has several predictors: counts of past outcomes, found
by a hash of a context (how often the contexts occurred, the count of the word before, how
the last two tokens were coded; for bits the last one to four and six bytes and all of the
word so far). A logistic mixer combines them with weights that a gate selects by evidence,
and an adaptive table refines the mixed probability. The probability of a token is the
mixture of its shares by the decisions' probabilities, so what the words predict in the
order in which they stand sums up to one. The sum of all logarithms is the score; over the
bytes it is bits per byte.

Nothing predicts itself: a training text is scored with each occurrence left out of the
counts that predict it, as an online coder would have met it. A text that occurs twice is
therefore told apart from one that occurs once.

Work on Spark: texts are stored in chunks of about `CHUNK_BYTES`. Each chunk sends the sorted
hashes of its distinct words, pairs and triples of words, with their training counts, in
slices of the hash range; a slice sums over all chunks and sends back only the sums, in the
chunk's order. Words have 62 bits; pairs and triples a table of 4,096 slots for each byte of
text, at least 2**40, so that it grows with the input (a pair shares its slot with another
once in some ten thousand). A chunk has each hash once, so no slice is hot. Then
each document holds the counts of its own tokens, and three maps follow: the predictors'
counts from all training tokens, the mixers' weights (each task one online pass over all its
training tokens, averaged by visits), and the scores. A spelled word is one that occurs
nowhere else, so spelling learns from all words of training texts that occur once.

Defined cases: a null or empty text is one end token; repeated rows are counted and scored
each; without training documents all words are spelled by untrained predictors; a null fold
is held out. Input columns named like an output column are replaced; any other name may
occur in the input.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import batches, carried, mixed, quoted, runs, schema_of, texts_of
from ledgerlake.session import cut_lineage

#: bytes looked back (0: the whole token so far), and the logarithm of the table's slots
CONTEXTS = ((1, 16), (2, 18), (3, 19), (4, 20), (6, 20), (0, 21))
EVIDENCE = (0.5, 3.5, 15.5, 255.5)  # counts of the whole token that divide the gates
END = b"\n"
CHUNK_BYTES = 6 << 20
SLOTS_A_BYTE, LEAST_SLOTS, MOST_SLOTS = 12, 40, 61  # logarithms; the lowest bit of a pair's key is free
NAMES = ("n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
MADE = "n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACED = bytes(32 if b == 32 or 9 <= b <= 13 else b for b in _LOWER)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(int(_ODD), -1, 1 << 64))
_PART = 1 << 15  # slots in one row of the summed tables
_STARTS = np.concatenate(([0], np.cumsum([1 << bits for _, bits in CONTEXTS])))
_SIZES = (256, 1 << 16, 400)  # slots of a decision's three predictors
_DECISION = sum(_SIZES)
_CELLS = 33  # of a refinement
_ZIP, _UNZIP = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def tokens_of(text: bytes | None) -> list[bytes]:
    """Words with A-Z in lower case, without the end token."""
    return text.translate(_LOWER).split() if text else []


# --- counts of words, pairs and triples


def packed(values: np.ndarray) -> bytes:
    """Whole numbers, the bytes of one significance together; the first byte is their width."""
    width = 8 if len(values) and values.max() >= 1 << 32 else 4
    digits = values.astype(f"<u{width}").view(np.uint8).reshape(-1, width)
    planes = np.empty((width, len(values)), np.uint8)
    for k in range(width):  # copied one by one, which is several times faster than a transposed copy
        planes[k] = digits[:, k]
    return bytes([width]) + _ZIP.compress(planes.tobytes())


def _planes(data: bytes) -> np.ndarray:
    return np.frombuffer(_UNZIP.decompress(data[1:]), np.uint8).reshape(data[0], -1)


def _joined(planes: np.ndarray) -> np.ndarray:
    """Numbers of the shape that each plane has."""
    digits = np.empty((*planes.shape[1:], len(planes)), np.uint8)
    for k, plane in enumerate(planes):
        digits[..., k] = plane
    return digits.view(f"<u{len(planes)}")[..., 0]


def unpacked(data: bytes) -> np.ndarray:
    return _joined(_planes(data)).astype(np.uint64)


def _counts_of(packs: Sequence[bytes]) -> np.ndarray:
    """The three counts of all tokens of some documents, in three rows."""
    if len({p[0] for p in packs}) > 1:
        return np.concatenate([unpacked(p).reshape(3, -1) for p in packs], axis=1)
    planes = [_planes(p).reshape(p[0], 3, -1) for p in packs]
    return _joined(np.concatenate(planes, axis=2)) if planes else np.empty((3, 0), np.uint64)


def grams(hashes: np.ndarray, starts: np.ndarray, bits: int) -> list[np.ndarray]:
    """Keys of each token's pair and triple; `starts` are the texts' first tokens."""
    before = [hashes]
    for _ in range(2):
        shifted = np.empty_like(hashes)
        shifted[1:] = before[-1][:-1]
        shifted[starts] = np.uint64(0)
        before.append(shifted)
    kept = np.uint64(((1 << bits) - 1) << (62 - bits))
    pair = mixed(before[1] * _ODD + hashes)
    triple = mixed(mixed(before[2] * _ODD + before[1]) * _INV + hashes)
    return [np.uint64(k << 62) | ((keys >> np.uint64(2)) & kept) for k, keys in ((1, pair), (2, triple))]


def _read(texts: Sequence[bytes | None]) -> tuple[pa.Array, np.ndarray]:
    """All tokens of some texts, and how many each has; the same as by `tokens_of`."""
    # a blank byte is a space, so that the only line ends are the end tokens
    parts = [b" " + t.translate(_SPACED) + b" \n" if t else b" \n" for t in texts]
    data = np.frombuffer(b"".join(parts) + b" ", np.uint8)
    solid = data != 32
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    offsets = np.concatenate(([0], np.cumsum(edges[1::2] - edges[::2])))
    data = data[solid]
    tokens = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return tokens, np.diff(np.flatnonzero(data[offsets[:-1]] == END[0]), prepend=-1)


def _words(tokens: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the different words, and which of them each token is."""
    coded = tokens.dictionary_encode()
    digests = b"".join(map(xxhash.xxh3_64_digest, coded.dictionary.to_pylist()))
    return np.frombuffer(digests, ">u8").astype(np.uint64), coded.indices.to_numpy()


def _starts(many: np.ndarray) -> np.ndarray:
    return np.cumsum(many) - many


def _free(names: Sequence[str], wish: str) -> str:
    while wish.lower() in {n.lower() for n in names}:
        wish += "_"
    return wish


def _chunked(rows: Iterator[pa.RecordBatch], text: str, chunk: str, place: str) -> Iterator[pa.RecordBatch]:
    """Rows with the number of their chunk and their place."""
    number, size, row = TaskContext.get().partitionId() << 32, 0, 0
    for batch in batches(rows, CHUNK_BYTES // 4):
        if size > CHUNK_BYTES:
            number, size = number + 1, 0
        size += batch.column(batch.schema.get_field_index(text)).nbytes
        batch = batch.append_column(chunk, pa.array(np.full(batch.num_rows, number, np.int64)))
        yield batch.append_column(place, pa.array(np.arange(row, row + batch.num_rows)))
        row += batch.num_rows


def _summed(keys: Sequence[np.ndarray], n: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(at, np.concatenate(n), len(found))


def _learnt(keys: np.ndarray, learns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different keys, whose lowest bit is free, and how many tokens of training each has."""
    marked = keys | learns
    marked.sort()
    keys = marked >> np.uint64(1)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first] << np.uint64(1), np.add.reduceat(marked & np.uint64(1), first)


def _send(bits: int, slices: int):
    """Each chunk's sorted keys with their training counts, cut into slices of the key range."""

    def written(chunk: int, sums: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        keys, n = (np.concatenate(c) for c in zip(*sums, strict=True))
        slot = ((keys >> np.uint64(32)) * np.uint64(slices) // np.uint64(3 << 30)).astype(np.int64)
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(slot)) + 1, [len(keys)]))
        for at, to in zip(cuts[:-1], cuts[1:], strict=True):
            steps = np.diff(keys[at:to], prepend=np.uint64(0))
            columns = [[chunk], [int(slot[at])], [packed(steps)], [packed(n[at:to])]]
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["chunk", "slice", "keys", "n"])

    def send(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches(rows, CHUNK_BYTES // 4), ["chunk"]):
            tokens, many = _read(texts_of(table.column("text")))
            learns = np.repeat(table.column("learns").to_numpy(), many)
            hashes, at = _words(tokens)
            word = _summed([hashes >> np.uint64(2)], [np.bincount(at, learns, len(hashes))])
            more = [_learnt(keys, learns) for keys in grams(hashes[at], _starts(many), bits)]
            yield from written(table.column("chunk")[0].as_py(), [word, *more])

    return send


def _sum(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of a slice for each chunk, in the chunk's order; and the words and tokens of training."""
    schema = pa.schema([("chunk", pa.int64()), ("slice", pa.int64()), ("sums", pa.binary()), ("words", pa.int64()), ("tokens", pa.int64())])
    for table in runs(rows, ["slice"]):
        place = table.column("slice")[0].as_py()
        parts: dict[int, list] = {}
        for chunk, keys, n in zip(*(table.column(c).to_pylist() for c in ("chunk", "keys", "n")), strict=True):
            parts.setdefault(chunk, []).append((np.cumsum(unpacked(keys), dtype=np.uint64), unpacked(n)))
        # a chunk that two tasks have read has sent a key twice
        own = [_summed(*zip(*p, strict=True)) if len(p) > 1 else p[0] for p in parts.values()]
        found, at = np.unique(np.concatenate([k for k, _ in own]), return_inverse=True)
        total = np.bincount(at, np.concatenate([n for _, n in own]), len(found))
        word = total[: np.searchsorted(found, np.uint64(1 << 62))]
        stats = [[-1], [place], [None], [int((word > 0).sum())], [int(word.sum())]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(stats, schema, strict=True)], schema=schema)
        start = 0
        for chunk, (keys, _) in zip(parts, own, strict=True):
            sums = packed(total[at[start : start + len(keys)]])
            start += len(keys)
            row = [[chunk], [place], [sums], [None], [None]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, schema, strict=True)], schema=schema)


def _kinds(rows: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """Stretches of one chunk and kind, batch by batch."""
    for batch in batches(rows):
        for run in runs(iter([batch]), keys):
            part = run.combine_chunks().to_batches()[0]
            yield part.column(keys[0])[0].as_py(), part.column(keys[1])[0].as_py(), part


def _placed(names: Sequence[str], own: dict[str, str], bits: int, total: int, words: int):
    """Documents with the counts of their tokens, from their chunk's sums."""
    size = math.log10(total + words + 1)

    def flush(sums: list[bytes], docs: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.concatenate([unpacked(s) for s in sums])
        tokens, many = _read([text for part in docs for text in texts_of(part.column(own["text"]))])
        hashes, at = _words(tokens)
        word, which = np.unique(hashes >> np.uint64(2), return_inverse=True)
        counts, start = np.empty((3, len(tokens)), np.uint64), len(word)
        counts[0] = count[:start][which][at]
        for own_counts, keys in zip(counts[1:], grams(hashes[at], _starts(many), bits), strict=True):
            found, which = np.unique(keys, return_inverse=True)
            own_counts[:] = count[start : start + len(found)][which]
            start += len(found)
        if start != len(count):
            raise RuntimeError("a chunk's sums are not those of its own keys")
        row, at = 0, 0
        for part in docs:
            mine = many[row : row + part.num_rows]
            to = at + int(mine.sum())
            yield counted(part, tokens.slice(at, to - at), mine, counts[:, at:to])
            row, at = row + part.num_rows, to

    def counted(part: pa.RecordBatch, tokens: pa.Array, many: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        learns = part.column(own["learns"])
        starts = _starts(many)
        base = np.log10(counts[0] + 1.0) - size
        unmet = counts[0] <= np.repeat(learns.to_numpy(zero_copy_only=False), many)
        ends = np.concatenate(([0], np.cumsum(np.add.reduceat(unmet, starts, dtype=np.int64))))
        new = tokens.filter(pa.array(unmet)).cast(pa.binary())
        length = np.add.reduceat(pc.binary_length(tokens).to_numpy(), starts)
        spans = [(at, at + n) for at, n in zip(starts.tolist(), many.tolist(), strict=True)]
        made = [
            pa.array(many),
            pa.array(np.add.reduceat(counts[0] > 0, starts, dtype=np.int64)),
            pa.array([float(base[at:to].sum()) for at, to in spans], pa.float64()),
            pa.array(length + many - 1),
            pa.array([packed(counts[:, at:to].ravel()) for at, to in spans], pa.binary()),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), new),
        ]
        kept = [part.column(part.schema.get_field_index(n)) for n in [*names, own["learns"]]]
        fields = ("n_tokens", "n_known", "base_score", own["size"], own["counts"], own["new"])
        return pa.RecordBatch.from_arrays([*kept, *made], names=[*names, own["learns"], *fields])

    def place(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sums, docs = None, [], []
        for chunk, kind, part in _kinds(rows, (own["chunk"], own["kind"])):
            if chunk != current and docs:
                yield from flush(sums, docs)
                sums, docs = [], []
            current = chunk
            if kind == 0:
                sums += part.column(own["sums"]).to_pylist()
            else:
                docs.append(part)
        if docs:
            yield from flush(sums, docs)

    return place


# --- spelling


class Code:
    """The way of each byte down a Huffman tree: nodes passed and branches taken."""

    def __init__(self, counts: np.ndarray):
        heap = [(float(n) + 1e-3, byte, byte) for byte, n in enumerate(counts)]
        heapq.heapify(heap)
        parent: dict[int, tuple[int, bool]] = {}
        for node in range(256, 511):
            (a, _, low), (b, _, high) = heapq.heappop(heap), heapq.heappop(heap)
            parent[low], parent[high] = (node, False), (node, True)
            heapq.heappush(heap, (a + b, node, node))
        ways = []
        for byte in range(256):
            way, at = [], byte
            while at in parent:
                at, branch = parent[at]
                way.append((at, branch))
            ways.append(way[::-1])
        self.size = np.array([len(w) for w in ways])
        self.start = np.cumsum(self.size) - self.size
        self.node = np.array([n for w in ways for n, _ in w], np.uint64)
        self.branch = np.array([b for w in ways for _, b in w], bool)


class Paths:
    """The bits of a list of tokens with their contexts."""

    def __init__(self, tokens: Sequence[bytes], code: Code):
        coded = [t if t == END else t + b" " for t in tokens]
        size = np.fromiter(map(len, coded), np.int64, len(coded))
        self.data = np.frombuffer(b"".join(coded), np.uint8)
        self.start = np.repeat(np.cumsum(size) - size, size)
        self.place = np.arange(len(self.data)) - self.start
        many = code.size[self.data]
        self.byte = np.repeat(np.arange(len(self.data)), many)  # of each bit
        at = (code.start[self.data] - (np.cumsum(many) - many)).take(self.byte)
        at += np.arange(len(at))
        self.bits, self.node = code.branch.take(at), code.node.take(at) * np.uint64(0xD6E8FEB86659FD93)
        self.owner = np.repeat(np.arange(len(coded)), size).take(self.byte)

    @cached_property
    def symbol(self) -> np.ndarray:
        return self.data.astype(np.uint64) + np.uint64(1)

    @cached_property
    def backs(self) -> list[np.ndarray]:
        """The symbols one, two and more bytes before, zero where the token begins later."""
        out = []
        for k in range(1, max(look for look, _ in CONTEXTS) + 1):
            back = np.zeros_like(self.symbol)
            back[k:] = self.symbol[: max(len(back) - k, 0)]
            back[self.place < k] = 0
            out.append(back)
        return out

    def slots(self, look: int, bits: int) -> np.ndarray:
        """The table slot of every bit under one context."""
        symbol = self.symbol
        if look:
            context = np.full(len(symbol), np.uint64(look))
            for back in self.backs[:look]:
                context += back
                context *= _ODD
        else:
            n = int(self.place.max()) + 1 if len(self.place) else 0
            powers = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(n, _INV))))
            sums = np.concatenate(([np.uint64(0)], np.add.accumulate(symbol * powers[self.place])))
            context = (sums[:-1] - sums[self.start]) * _ODD
        context ^= context >> np.uint64(31)
        spread = context.take(self.byte)
        spread += self.node
        spread *= np.uint64(0xC4CEB9FE1A85EC53)
        spread >>= np.uint64(64 - bits)
        return spread.view(np.int64)


# --- predictors, mixers and refinements


class Blend:
    """Gated weights over predictors, and the refinement of what they give."""

    def __init__(self, gates: int, predictors: int):
        grid = 1 / (1 + np.exp(-np.linspace(-8, 8, _CELLS)))
        self.weights = np.full((gates, predictors), 1.5 / predictors)
        self.bias = np.zeros(gates)
        self.refine = np.tile(grid, (gates, 1))  # by gate and bucket of the mixed prediction
        self.moved = np.ones((gates, predictors + 1))
        self.visits = np.zeros(gates)

    def plain(self, stretched: np.ndarray, gate: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The mixed probability of a one, and the refinement's bucket and share."""
        total = self.bias.take(gate)
        for each, weight in zip(stretched, self.weights.T, strict=True):
            total += each * weight.take(gate)
        np.clip(total, -12, 12, out=total)
        p = 1 / (1 + np.exp(-total))
        total += 8
        total *= 2
        spot = np.clip(total, 0, _CELLS - 1, out=total)
        low = np.minimum(spot.astype(np.int64), _CELLS - 2)
        return p, low, spot - low

    def mixed(self, stretched: np.ndarray, gate: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The mixed probability of a one, its refinement, and the refinement's bucket and share."""
        p, low, share = self.plain(stretched, gate)
        cell, cells = gate * _CELLS + low, self.refine.reshape(-1)
        refined = cells.take(cell) * (1 - share) + cells.take(cell + 1) * share
        return p, refined, low, share

    @staticmethod
    def final(p: np.ndarray, refined: np.ndarray) -> np.ndarray:
        """The refinement has its say where its table reaches."""
        return np.clip(np.where(np.abs(p - 0.5) < 0.4995, (p + refined) / 2, p), 1e-6, 1 - 1e-6)

    def learn(self, stretched: np.ndarray, gate: np.ndarray, target: np.ndarray, mix: tuple | None = None) -> None:
        """One online step towards outcomes, or the shares that a decision has in them; `mix` is `plain`, if known."""
        gates = len(self.bias)
        p, low, share = mix or self.plain(stretched, gate)
        error = target - p
        slopes = [np.bincount(gate, error * each, gates) for each in stretched]
        slope = np.column_stack([*slopes, np.bincount(gate, error, gates)])
        self.moved += slope**2  # steps shrink with the way a weight has gone
        step = 0.1 * slope / np.sqrt(self.moved)
        self.weights += step[:, :-1]
        self.bias += step[:, -1]
        self.visits += np.bincount(gate, minlength=gates)
        flat = np.concatenate([gate * _CELLS + low, gate * _CELLS + low + 1])
        part = np.concatenate([1 - share, share])
        seen = np.bincount(flat, part, gates * _CELLS)
        hit = np.bincount(flat, part * np.tile(target, 2), gates * _CELLS)
        known = seen > 0
        cells = self.refine.reshape(-1)
        cells[known] += np.minimum(seen[known] / 300, 0.5) * (hit[known] / seen[known] - cells[known])

    def numbers(self) -> tuple[np.ndarray, np.ndarray]:
        """All parameters in one row, and the visits that each has had."""
        by_gate = self.visits
        seen = [np.repeat(by_gate, self.weights.shape[1]), by_gate, np.repeat(by_gate, _CELLS)]
        return np.concatenate([self.weights.ravel(), self.bias, self.refine.ravel()]), np.concatenate(seen)

    def set(self, numbers: np.ndarray) -> None:
        w, b = self.weights.size, self.bias.size
        self.weights = numbers[:w].reshape(self.weights.shape)
        self.bias = numbers[w : w + b]
        self.refine = numbers[w + b :].reshape(self.refine.shape)


def _stretch(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.log((np.maximum(ones, 0) + 0.4) / (np.maximum(zeros, 0) + 0.4))


@dataclass
class Spelling:
    """New words, bit by bit."""

    code: Code
    counts: np.ndarray  # zeros and ones by slot as one number, the contexts' tables one after another
    blend: Blend

    @staticmethod
    def fresh() -> Blend:
        return Blend(len(CONTEXTS) * (len(EVIDENCE) + 1), len(CONTEXTS))

    @classmethod
    def untrained(cls, code: Code, zeros: np.ndarray, ones: np.ndarray) -> Spelling:
        return cls(code, np.column_stack((zeros, ones)).astype("f4").view(np.complex64).ravel(), cls.fresh())

    def inputs(self, paths: Paths, left_out: np.ndarray | bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Stretched predictions by context and bit, and each bit's gate."""
        stretched = np.empty((len(CONTEXTS), len(paths.bits)), np.float32)
        gate = np.zeros(len(paths.bits), np.uint8)
        own = np.zeros((len(paths.bits), 2), np.float32)  # zeros and ones of a bit's own
        own[:, 0], own[:, 1] = left_out & ~paths.bits, left_out & paths.bits
        for k, (look, bits) in enumerate(CONTEXTS):
            at = paths.slots(look, bits)
            at += _STARTS[k]
            both = self.counts.take(at).view(np.float32).reshape(-1, 2)
            both -= own
            np.maximum(both, 0, out=both)
            seen = both[:, 0] + both[:, 1]
            if look:
                gate += seen >= 2
            else:
                for least in EVIDENCE:
                    gate += np.uint8(len(CONTEXTS)) * (seen > least)
            both += np.float32(0.4)
            np.log(np.divide(both[:, 1], both[:, 0], out=seen), out=stretched[k])
        return stretched, gate.astype(np.int64)

    def costs(self, tokens: Sequence[bytes], left_out: np.ndarray, batch: int = 1024) -> np.ndarray:
        """log10 of each token's probability; tokens left out have fed the counts once."""
        out = np.zeros(len(tokens))
        for at in range(0, len(tokens), batch):
            paths = Paths(tokens[at : at + batch], self.code)
            p, refined, _, _ = self.blend.mixed(*self.inputs(paths, left_out[at : at + batch][paths.owner]))
            final = self.blend.final(p, refined)
            each = np.log10(np.where(paths.bits, final, 1 - final))
            out[at : at + batch] = np.bincount(paths.owner, each, minlength=len(out[at : at + batch]))
        return out

    def train(self, tokens: Sequence[bytes], batch: int = 1024) -> None:
        """One online pass over tokens that have fed the counts, a batch at a time."""
        for at in range(0, len(tokens), batch):
            paths = Paths(tokens[at : at + batch], self.code)
            stretched, gate = self.inputs(paths, left_out=True)
            self.blend.learn(stretched, gate, paths.bits.astype(float))

    @staticmethod
    def tally(tokens: Sequence[bytes], code: Code, counts: np.ndarray) -> None:
        """Add the bits of tokens to zeros and ones by slot."""
        flat, one = counts.reshape(-1), counts.dtype.type(1)
        for at in range(0, len(tokens), 4096):
            paths = Paths(tokens[at : at + 4096], code)
            for k, (look, bits) in enumerate(CONTEXTS):
                np.add.at(flat, (paths.slots(look, bits) + _STARTS[k]) * 2 + paths.bits, one)


class Decisions:
    """For all tokens of some texts: the shares of their words, and what can tell a decision."""

    def __init__(self, counts: Sequence[np.ndarray], many: np.ndarray, learns: np.ndarray, total: int):
        self.many, starts = many, _starts(many)
        self.own = np.repeat(learns, many).astype(float)  # an occurrence that is left out
        ends = np.repeat(counts[0][starts + many - 1].astype(float), many)  # training texts
        place = np.arange(len(self.own)) - np.repeat(starts, many)

        def before(values: np.ndarray, first: np.ndarray) -> np.ndarray:
            return np.where(place > 0, np.concatenate((values[:1], values[:-1])), first)

        n = [c - self.own for c in counts]
        self.all = [
            np.full(len(self.own), float(total)) - self.own,
            before(counts[0].astype(float), ends) - self.own,
            before(counts[1].astype(float), ends) - self.own,
        ]
        self.coded = [a > 0 for a in self.all]
        self.share = [np.where(a > 0, k / np.maximum(a, 1), 0.0) for k, a in zip(n, self.all, strict=True)]
        self.seen = [s > 0 for s in self.share]
        known = self.seen[0].astype(np.int64)
        way = known + (self.seen[0] & self.seen[1]) + (self.seen[0] & self.seen[1] & self.seen[2])
        last = before(way, np.full(len(way), 4))
        self.history = last * 5 + np.where(place > 1, np.concatenate((last[:1], last[:-1])), 4)
        self.level = [np.minimum(np.log2(np.maximum(a, 0) + 1).astype(np.int64), 15) for a in self.all]
        word = mixed(np.maximum(self.all[1], 0).astype(np.uint64))
        self.word = (word >> np.uint64(48)).astype(np.int64)

    def slots(self, order: int) -> list[np.ndarray]:
        """Of a decision's predictors, in the table of all decisions."""
        other = self.level[2] if order == 1 else self.level[1]
        base = order * _DECISION
        own = (self.level[order] * 16 + other, self.word, self.history * 16 + self.level[order])
        return [base + sum(_SIZES[:k]) + at for k, at in enumerate(own)]

    def inputs(self, order: int, odds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out = np.where(self.own > 0, np.where(self.seen[order], 1, 2), 0) * odds.shape[1]
        stretched = [odds.reshape(-1).take(out + at) for at in self.slots(order)]
        return np.array(stretched), order * 16 + self.level[order]

    def tally(self, zeros: np.ndarray, ones: np.ndarray) -> None:
        """Outcomes of training texts by slot."""
        for order in range(3):
            fed = (self.own > 0) & self.coded[order]
            hit, missed = fed & self.seen[order], fed & ~self.seen[order]
            for at in self.slots(order):
                np.add.at(ones, at[hit], 1.0)
                np.add.at(zeros, at[missed], 1.0)


def stretched_odds(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Predictions by slot: with all outcomes, with a one left out, with a zero left out."""
    zeros, ones = zeros.astype(float), ones.astype(float)
    return np.array([_stretch(zeros, ones), _stretch(zeros, ones - 1), _stretch(zeros - 1, ones)])


def learn_decisions(d: Decisions, blend: Blend, odds: np.ndarray) -> None:
    """One online step towards the shares that the decisions have in the tokens of training texts."""
    chance = np.zeros(len(d.own))
    for order in range(3):
        stretched, gate = d.inputs(order, odds)
        p, refined, low, share = blend.mixed(stretched, gate)
        g = np.where(d.coded[order], blend.final(p, refined), 0.0)
        drawn = g * d.share[order]
        chance = drawn + (chance * (1 - g) if order else 0)
        fed = (d.own > 0) & d.coded[order]
        # the share that this decision has in the token's probability
        part = d.seen[0].astype(float) if order == 0 else drawn / np.maximum(chance, 1e-300)
        blend.learn(stretched[:, fed], gate[fed], part[fed], (p[fed], low[fed], share[fed]))


def decide(d: Decisions, blend: Blend, odds: np.ndarray) -> np.ndarray:
    """log10 of each token's probability; of a new word only what comes before its spelling."""
    out = np.zeros(len(d.own))
    chance = np.zeros(len(d.own))
    for order in range(3):
        p, refined, _, _ = blend.mixed(*d.inputs(order, odds))
        g = np.where(d.coded[order], blend.final(p, refined), 0.0)
        chance = g * d.share[order] + (chance * (1 - g) if order else 0)
        left = np.flatnonzero(~d.seen[0])  # only a new word's way out is asked for
        out[left] += np.log10(1 - g[left])
    out[d.seen[0]] = np.log10(np.maximum(chance[d.seen[0]], 1e-300))
    return out


def _decided(batch: pa.RecordBatch, own: dict[str, str], total: int) -> tuple[Decisions, list[bytes], np.ndarray]:
    """Decisions, new words and their documents, of one batch of counted documents."""
    many = batch.column("n_tokens").to_numpy().astype(np.int64)
    learns = batch.column(own["learns"]).to_numpy(zero_copy_only=False).astype(bool)
    counts = _counts_of(batch.column(own["counts"]).to_pylist())
    new = batch.column(own["new"])
    owner = np.repeat(np.arange(len(many)), new.value_lengths().to_numpy())
    return Decisions(list(counts), many, learns, total), new.flatten().to_pylist(), owner


# --- the model


@dataclass
class Model:
    """What is known of all training texts."""

    total: int  # tokens
    words: int  # different ones
    zeros: np.ndarray  # of decisions
    ones: np.ndarray
    blend: Blend
    spelling: Spelling

    @cached_property
    def odds(self) -> np.ndarray:
        return stretched_odds(self.zeros, self.ones)

    def scores(self, batch: pa.RecordBatch, own: dict[str, str]) -> np.ndarray:
        """log10 of the probability of each text."""
        d, new, owner = _decided(batch, own, self.total)
        documents = np.repeat(np.arange(len(d.many)), d.many)
        cost = np.bincount(documents, decide(d, self.blend, self.odds), len(d.many))
        left_out = batch.column(own["learns"]).to_numpy(zero_copy_only=False).astype(bool)[owner]
        return cost + np.bincount(owner, self.spelling.costs(new, left_out), len(d.many))


def _parts(counts: np.ndarray, first: int = 0) -> Iterator[pa.RecordBatch]:
    for i, row in enumerate(counts):
        if row.any():
            columns = [pa.array([first + i], pa.int32()), pa.array([zlib.compress(row.astype("<f4").tobytes(), 1)], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "counts"])


def _code(learning: DataFrame, new: str) -> Code:
    """The tree for the bytes of all words that occur once."""

    def tally(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(256, np.int64)
        for batch in rows:
            tokens = batch.column(0).flatten().to_pylist()
            counts += np.bincount(np.frombuffer(b"".join(tokens), np.uint8), minlength=256)
            counts[32] += len(tokens)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(counts)], names=["byte", "n"])

    counts = np.zeros(256)
    for byte, n in learning.select(quoted(new)).mapInArrow(tally, "byte long, n long").groupBy("byte").agg(F.sum("n")).collect():
        counts[byte] = n
    return Code(counts)


def _tables(learning: DataFrame, own: dict[str, str], code: Code, total: int) -> np.ndarray:
    """Outcomes by slot, zeros and ones, of all decisions and then of all spelled bits."""
    size = -(-(3 * _DECISION + int(_STARTS[-1])) // _PART) * _PART

    def tally(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decided, spelled = np.zeros((2, 3 * _DECISION)), np.zeros((_STARTS[-1], 2), np.int32)
        for batch in batches(rows, 1 << 18):
            d, new, _ = _decided(batch, own, total)
            d.tally(*decided)
            Spelling.tally(new, code, spelled)
        for side in range(2):
            whole = np.zeros(size, np.float32)
            whole[: 3 * _DECISION] = decided[side]
            whole[3 * _DECISION : 3 * _DECISION + _STARTS[-1]] = spelled[:, side]
            yield from _parts(whole.reshape(-1, _PART), side * (size // _PART))

    def add(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summed: dict[int, np.ndarray] = {}
        for batch in rows:
            for part, raw in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                summed[part] = summed.get(part, 0) + np.frombuffer(zlib.decompress(raw), "<f4").astype(float)
        for part, counts in summed.items():
            yield from _parts(counts[None, :], part)

    schema = "part int, counts binary"
    summed = learning.mapInArrow(tally, schema).repartition("part").mapInArrow(add, schema).toArrow()
    counts = np.zeros((2 * size // _PART, _PART), np.float32)
    for part, raw in zip(summed.column("part").to_pylist(), summed.column("counts").to_pylist(), strict=True):
        counts[part] = np.frombuffer(zlib.decompress(raw), "<f4")
    return counts.reshape(2, -1)


def fit(counted: DataFrame, own: dict[str, str], total: int, words: int) -> Model:
    """The model of counted documents, from those that are for learning."""
    learning = counted.where(quoted(own["learns"])).select("n_tokens", *[quoted(own[c]) for c in ("learns", "counts", "new")])
    code = _code(learning, own["new"])
    tables = _tables(learning, own, code, total)
    at = 3 * _DECISION
    zeros, ones = tables[:, :at]
    spelling = Spelling.untrained(code, *tables[:, at : at + _STARTS[-1]])
    model = Model(total, words, zeros, ones, Blend(48, len(_SIZES)), spelling)
    shared = counted.sparkSession.sparkContext.broadcast(model)

    def train(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        untrained = shared.value
        blend = Blend(48, len(_SIZES))
        spelling = replace(untrained.spelling, blend=Spelling.fresh())
        for batch in batches(rows, 1 << 16):
            d, new, _ = _decided(batch, own, total)
            learn_decisions(d, blend, untrained.odds)
            spelling.train(new)
        value, seen = (np.concatenate(c) for c in zip(blend.numbers(), spelling.blend.numbers(), strict=True))
        columns = [pa.array(np.arange(len(value))), pa.array(value * seen), pa.array(seen)]
        yield pa.RecordBatch.from_arrays(columns, names=["at", "value", "seen"])

    trained = learning.mapInArrow(train, "at long, value double, seen double").groupBy("at").agg(F.sum("value"), F.sum("seen"))
    numbers = np.concatenate([model.blend.numbers()[0], spelling.blend.numbers()[0]])
    for i, value, seen in trained.collect():
        if seen:
            numbers[i] = round(value / seen, 6)  # sums of the tasks come in any order
    cut = len(model.blend.numbers()[0])
    model.blend.set(numbers[:cut])
    spelling.blend.set(numbers[cut:])
    shared.destroy()
    return model


def count(docs: DataFrame, training: Column, text: str, names: Sequence[str]) -> tuple[DataFrame, dict[str, str], int, int]:
    """Documents with the training counts of their tokens, their columns' names, tokens and words of training."""
    taken = [*names, *NAMES]
    own = {w: _free(taken, f"_{w}") for w in ("text", "learns", "chunk", "kind", "slice", "sums", "size", "counts", "new")}
    columns = [quoted(n) for n in names]
    learns = F.coalesce(training, F.lit(False)).alias(own["learns"])
    plain = docs.select(*columns, learns, quoted(text).cast("string").alias(own["text"]))
    made = f"`{own['chunk']}` long, `{own['slice']}` long"

    def chunk(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _chunked(rows, own["text"], own["chunk"], own["slice"])

    stored = cut_lineage(plain.mapInArrow(chunk, schema_of(plain, plain.columns, made)), "texts")
    length = F.coalesce(F.sum(F.octet_length(quoted(own["text"]))), F.lit(0))
    chunks, size = stored.agg(F.count_distinct(quoted(own["chunk"])), length).first()
    bits = min(MOST_SLOTS, max(LEAST_SLOTS, SLOTS_A_BYTE + size.bit_length()))
    only = stored.select(*[quoted(own[c]).alias(c) for c in ("chunk", "learns", "text")])
    sent = only.mapInArrow(_send(bits, max(8, chunks)), "chunk long, slice long, keys binary, n binary")
    dealt = sent.repartition("slice").sortWithinPartitions("slice")
    summed = cut_lineage(dealt.mapInArrow(_sum, "chunk long, slice long, sums binary, words long, tokens long"), "sums")
    zero = F.lit(0)
    words, total = summed.agg(F.coalesce(F.sum("words"), zero), F.coalesce(F.sum("tokens"), zero)).first()
    sums = summed.where("chunk >= 0").select(*[F.col(c).alias(own[c]) for c in ("chunk", "slice", "sums")])
    both = sums.withColumn(own["kind"], F.lit(0)).unionByName(stored.withColumn(own["kind"], F.lit(1)), allowMissingColumns=True)
    keys = [quoted(own[c]) for c in ("chunk", "kind", "slice")]
    beside = both.repartition(keys[0]).sortWithinPartitions(*keys)
    fields = f"`{own['learns']}` boolean, n_tokens long, n_known long, base_score double"
    fields += f", `{own['size']}` long, `{own['counts']}` binary, `{own['new']}` array<binary>"
    placed = beside.mapInArrow(_placed(names, own, bits, total, words), schema_of(docs, names, fields))
    return cut_lineage(placed, "counted"), own, total, words


def score(docs: DataFrame, training: Column, text: str = "text", carry: Sequence[str] | None = None) -> DataFrame:
    """Documents with token counts, the unigram score and the model's score, both as log10."""
    names = carried(docs, carry, NAMES)
    counted, own, total, words = count(docs, training, text, names)
    return judged(counted, own, names, fit(counted, own, total, words))


def judged(counted: DataFrame, own: dict[str, str], names: Sequence[str], model: Model) -> DataFrame:
    """Counted documents with their scores."""
    shared, total = counted.sparkSession.sparkContext.broadcast(model), model.total

    def judge(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, 1 << 18):
            cost = shared.value.scores(batch, own)
            kept = {n: batch.column(batch.schema.get_field_index(n)) for n in [*names, "n_tokens", "n_known", "base_score"]}
            bits = -cost * math.log2(10) / np.maximum(batch.column(own["size"]).to_numpy(), 1)
            made = {"train_tokens": pa.array(np.full(len(cost), total, np.int64)), "score": pa.array(cost), "bits_per_byte": pa.array(bits)}
            out = {**kept, **made}
            yield pa.RecordBatch.from_arrays([out[n] for n in [*names, *NAMES]], names=[*names, *NAMES])

    return counted.mapInArrow(judge, schema_of(counted, names, MADE))
