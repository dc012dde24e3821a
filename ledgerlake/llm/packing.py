"""Best-fit packing of tokenised documents under several capacities.

Documents become token ids (a public tokenizer's file, then an end id), cut at the sequence
length only where they are longer. Pieces are dealt evenly over groups of a fixed number of
tokens; each group is packed by itself, longest piece first. A bin's residual capacities
(tokens, documents, attention cost as the sum of squared lengths) must all hold a piece, and
of the bins that can, the weighted dot product of piece and residual, or the norm of what
would remain, picks one. A group ends with about one bin that is not full, so the whole
has about one spare sequence in every 2,000.

The pieces are stored once, in the shared folder, because their total decides the number of
groups; a lost task reads them again and packs the same way.

Encoding goes word by word with a memory of encoded words: the tokenizer drops white space
and never joins across it, so a text's ids are its words' ids in a row. A batch's words are
told apart and looked up as Arrow columns; only new ones become Python objects. Where a
probe shows that the tokenizer also lower-cases and cuts between letters, digits and marks,
a new word of ASCII or Latin-1 is put together from such pieces, of which there are fewer.
New pieces of letters go to the tokenizer's model, which is all that they would pass through,
the others are encoded many at a time, with a special token between them. A test holds this
against encoding whole texts.

Defined cases: a null or empty text is the end id alone; repeated documents are packed each;
an empty table has no pieces. Input columns named like an output column are replaced.
"""

from __future__ import annotations

import math
import os
import re
import zlib
from collections.abc import Iterator, Sequence
from itertools import chain
from string import ascii_lowercase

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import batches, beside, carried, prefix, quoted, schema_of
from ledgerlake.session import cut_lineage

MAX_TOKENS = 4096
END_ID = 1
GROUP_TOKENS = 8 << 20
MADE = "piece int, start long, length long, ids_crc32 long"

_SEPARATOR = "<|endoftext|>"
_PIECES = re.compile(rb"[a-z]+|[0-9]|[^a-z0-9]+")
# the same with the letters of Latin-1, which stand alone: none joins the one before it
_LATIN = re.compile("[\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\xff]*")
_LATIN_PIECES = re.compile("[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff]+")
_LETTERS = re.compile("[a-z\xdf-\xf6\xf8-\xff]+")


class Growing:
    """A numpy array that grows at its end; what is there is not copied for each addition."""

    def __init__(self, kind):
        self.room, self.n = np.empty(1 << 10, kind), 0

    def add(self, more) -> None:
        to = self.n + len(more)
        if to > len(self.room):
            wider = np.empty(max(to, 2 * len(self.room)), self.room.dtype)
            wider[: self.n] = self.room[: self.n]
            self.room = wider
        self.room[self.n : to] = more
        self.n = to

    @property
    def values(self) -> np.ndarray:
        return self.room[: self.n]


class Stretches:
    """Stretches of ids by row, one behind the other."""

    def __init__(self):
        self.ids, self.starts, self.sizes = Growing(np.uint32), Growing(np.int64), Growing(np.int64)

    def add(self, ids: np.ndarray, sizes) -> None:
        sizes = np.asarray(sizes, np.int64)
        self.starts.add(self.ids.n + np.cumsum(sizes) - sizes)
        self.sizes.add(sizes)
        self.ids.add(ids)

    def gathered(self, rows: np.ndarray) -> np.ndarray:
        """The stretches of the rows, one after another."""
        size = self.sizes.values[rows]
        before = np.cumsum(size) - size
        return self.ids.values[np.repeat(self.starts.values[rows] - before, size) + np.arange(size.sum())]


class Known:
    """Values in the order they were met, as one Arrow column: a few bytes each beside their own."""

    def __init__(self):
        self.values = pa.array([], pa.large_binary())

    def __len__(self) -> int:
        return len(self.values)

    def rows(self, given: pa.Array) -> tuple[np.ndarray, list[bytes]]:
        """The row of each value, and those that were new, in their order."""
        met = given.dictionary_encode()
        found = pc.index_in(met.dictionary, self.values)
        new = met.dictionary.filter(found.is_null())
        row = found.fill_null(-1).to_numpy().astype(np.int64)
        row[row < 0] = len(self) + np.arange(len(new))
        self.values = pa.concat_arrays([self.values, new])
        return row[met.indices.to_numpy()], new.to_pylist()


class Encoder:
    """Ids of texts, with a bounded memory of the words of earlier ones."""

    def __init__(self, path: str, most: int = 500_000):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has its own tasks
        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.mark = self.tokenizer.token_to_id(_SEPARATOR)
        self.cuts = self._cuts()
        self.model = self.tokenizer.model
        self.ways = self._ways()
        self._forget()

    def _forget(self) -> None:
        self.known, self.words = Known(), Stretches()
        self.known_pieces, self.pieces = Known(), Stretches()

    def _cuts(self) -> bool:
        """Whether words fall into lower-cased runs of letters, single digits and runs of marks."""
        before = self.tokenizer.pre_tokenizer
        if before is None:
            return False
        probe = "Ab12,;cD_e<$>(-)#~F"
        normal = self.tokenizer.normalizer.normalize_str(probe) if self.tokenizer.normalizer else probe
        found = [normal[a:b] for _, (a, b) in before.pre_tokenize_str(normal)]
        return normal == probe.lower() and found == [p.decode() for p in _PIECES.findall(probe.lower().encode())]

    def _ways(self) -> dict[int, str] | None:
        """How the model writes letters; None where a run of them is not left to the model alone."""
        tokenizer, latin = self.tokenizer, "".join(map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0x100)]))
        if not self.cuts or any(t.content.isalpha() for t in tokenizer.get_added_tokens_decoder().values()):
            return None
        ways = {ord(c): "".join(p for p, _ in tokenizer.pre_tokenizer.pre_tokenize_str(c)) for c in latin}
        lower = [ascii_lowercase, latin, *(f"{a}{c}{b}" for c in ascii_lowercase + latin for a, b in (("", ""), ("", "e"), ("n", "")))]
        for run in [*lower, *(r.upper() for r in lower if "\xdf" not in r and "\xff" not in r)]:
            own = [t.id for t in self.model.tokenize(run.lower().translate(ways))]
            if own != tokenizer.encode(run, add_special_tokens=False).ids:
                return None
        return ways

    def _cut(self, word: bytes) -> list[bytes]:
        """The pieces that a word's ids are put together from."""
        if word.isalpha():  # of bytes: A to Z alone
            return [word.lower()]
        if b"'" in word or b"<|" in word:
            return [word]
        if word.isascii():
            return _PIECES.findall(word.lower())
        text = word.decode("utf-8", "replace")
        if self.ways is None or not _LATIN.fullmatch(text):
            return [word]
        return [p.encode() for p in _LATIN_PIECES.findall(text.lower())]

    def _encode(self, words: list[bytes]) -> None:
        """Append the ids of words, which are new."""
        cut = [self._cut(w) for w in words] if self.cuts else [[w] for w in words]
        rows, new = self.known_pieces.rows(pa.array(list(chain.from_iterable(cut)), pa.large_binary()))
        self._learn(new)
        sizes = self.pieces.sizes.values[rows]
        ends = np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut)))
        of_word = np.diff(np.r_[0, np.cumsum(sizes)][np.r_[0, ends]])  # an empty word has no piece
        self.words.add(self.pieces.gathered(rows), of_word)

    def _learn(self, words: list[bytes]) -> None:
        """Append the ids of pieces, or of words that are not cut."""
        found: list[list[int]] = [[]] * len(words)
        others = []
        for i, word in enumerate(words):
            text = word.decode("utf-8", "replace")
            if self.ways is not None and _LETTERS.fullmatch(text):
                found[i] = [t.id for t in self.model.tokenize(text if text.isascii() else text.translate(self.ways))]
            else:
                others.append(i)
        for i, own in zip(others, self._whole([words[i] for i in others]), strict=True):
            found[i] = own
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self.pieces.add(np.fromiter(chain.from_iterable(found), np.uint32, sizes.sum()), sizes)

    def _whole(self, words: list[bytes]) -> Iterator[list[int]]:
        """The ids of words that take the tokenizer's whole way."""
        texts = [w.decode("utf-8", "replace") for w in words]
        for at in range(0, len(texts), 1 << 14):
            groups = [texts[k : k + 64] for k in range(at, min(at + (1 << 14), len(texts)), 64)]
            joined = [_SEPARATOR.join(g) for g in groups]
            for group, whole, found in zip(groups, joined, self._ids(joined), strict=True):
                if self.mark is None or whole.count("<|") != len(group) - 1:
                    yield from (own.tolist() for own in self._ids(group))  # some word may hold a special token itself
                else:
                    cuts = np.flatnonzero(found == self.mark)
                    yield from (own.tolist() for own in np.split(found[found != self.mark], cuts - np.arange(len(cuts))))

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, texts: pa.Array | Sequence[bytes | None], end: int) -> Iterator[np.ndarray]:
        """The ids of each text, followed by the end id."""
        if len(self.known) > self.most:
            self._forget()
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_binary())
        split = pc.ascii_split_whitespace(column.cast(pa.large_binary()).view(pa.large_string()))
        many = split.value_lengths().fill_null(0).to_numpy()
        rows, new = self.known.rows(split.flatten().view(pa.large_binary()))
        self._encode(new)
        at = 0
        for n in many.tolist():
            yield np.append(self.words.gathered(rows[at : at + n]), np.uint32(end)).astype("<u4")
            at += n


_ENCODERS: dict[str, Encoder] = {}


def tokenize(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    max_tokens: int = MAX_TOKENS,
    end_id: int = END_ID,
    carry: Sequence[str] | None = None,
    keep_ids: bool = True,
    reuse: bool = True,
) -> DataFrame:
    """A row for each piece of a document: piece, start, length, ids_crc32, and `ids` unless dropped.

    With `reuse` a worker keeps its encoded words for its next tasks, which saves work;
    without, a task's memory ends with it, for jobs that go on with something else.
    """
    names = carried(docs, carry, ["piece", "start", "length", "ids_crc32", "ids"])
    schema = schema_of(docs, names, MADE + (", ids array<int>" if keep_ids else ""))

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if reuse and tokenizer not in _ENCODERS:
            _ENCODERS[tokenizer] = Encoder(tokenizer)
        encoder = _ENCODERS[tokenizer] if reuse else Encoder(tokenizer)
        for batch in batches(rows, 4 << 20):
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, own in enumerate(encoder(batch.column("_text"), end_id)):
                for k, begin in enumerate(range(0, len(own), max_tokens)):
                    part = own[begin : begin + max_tokens]
                    row.append(i)
                    piece.append(k)
                    start.append(begin)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    if keep_ids:
                        ids.append(part.astype(np.int32))
            made = {
                "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()),
            }
            if keep_ids:
                made["ids"] = pa.array(ids, pa.list_(pa.int32()))
            yield beside(batch.take(pa.array(row, pa.int32())), names, made)

    return prefix(docs, names, text).mapInArrow(cut, schema)


def best_fit(
    lengths: np.ndarray,
    capacities: tuple[float, float, float],
    weights: Sequence[float] = (1.0, 0.1, 0.1),
    rule: str = "norm",
) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; capacities of a bin are tokens, pieces and sum of squares."""
    if len(lengths) and (lengths.max() > capacities[0] or float(lengths.max()) ** 2 > capacities[2] or capacities[1] < 1):
        raise ValueError("a piece alone is beyond a capacity")
    size = np.asarray(capacities, float)
    weight = np.asarray(weights, float)[:, None]
    order = np.argsort(-lengths, kind="stable")
    smallest = float(lengths.min()) if len(lengths) else 0.0
    least = np.array([smallest, 1.0, smallest**2]) / size
    chosen, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room = np.empty((3, 64))  # open bins' residuals, as shares of the capacities
    names = np.empty(64, np.int64)
    used, bins = 0, 0
    slack = 1e-12
    for i in order:
        n = int(lengths[i])
        need = (np.array([n, 1.0, float(n) * n]) / size)[:, None]
        left = room[:, :used] - need
        fits = (left >= -slack).all(axis=0)
        if fits.any():
            score = (weight * left**2).sum(axis=0) if rule == "norm" else (weight * need * room[:, :used]).sum(axis=0)
            k = int(np.argmin(np.where(fits, score, np.inf)))
            room[:, k] = left[:, k]
        else:
            if used == room.shape[1]:
                room = np.concatenate([room, np.empty_like(room)], axis=1)
                names = np.concatenate([names, np.empty_like(names)])
            k, used = used, used + 1
            room[:, k], names[k] = 1.0 - need[:, 0], bins
            bins += 1
        chosen[i] = names[k]
        offset[i] = round((1.0 - room[0, k]) * size[0]) - n
        if (room[:, k] < least - slack).any():  # no piece fits any more
            used -= 1
            room[:, k], names[k] = room[:, used], names[used]
    return chosen, offset


def pack(
    pieces: DataFrame,
    max_tokens: int = MAX_TOKENS,
    max_documents: int | None = None,
    max_cost: float | None = None,
    rule: str = "norm",
    group_tokens: int = GROUP_TOKENS,
    length: str = "length",
) -> DataFrame:
    """The pieces with sequence_id and offset. Unset capacities are those that never bind."""
    capacities = (float(max_tokens), float(max_documents or max_tokens), float(max_cost or max_tokens**2))
    names = carried(pieces, None, ["sequence_id", "offset"])
    stored = cut_lineage(pieces.select(*[quoted(n) for n in names]), "pieces")
    total = stored.agg(F.sum(quoted(length))).first()[0] or 0

    def place(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in rows if batch.num_rows]
        if not held:
            return
        sizes = np.concatenate([b.column(length).to_numpy() for b in held])
        chosen, offset = best_fit(sizes, capacities, rule=rule)
        chosen += TaskContext.get().partitionId() << 32
        at = 0
        for batch in held:
            to = at + batch.num_rows
            yield beside(batch, names, {"sequence_id": pa.array(chosen[at:to]), "offset": pa.array(offset[at:to])})
            at = to

    groups = max(1, math.ceil(total / group_tokens))
    return stored.repartition(groups).mapInArrow(place, schema_of(stored, names, "sequence_id long, offset long"))


def sequences(packed: DataFrame, document: str = "doc_id") -> DataFrame:
    """The training sequences themselves: input_ids, with the documents and lengths they are made of."""
    part = F.struct("offset", "length", quoted(document).alias("doc"), "ids")
    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    return rows.select(
        "sequence_id",
        F.flatten("parts.ids").alias("input_ids"),
        F.col("parts.doc").alias("doc_ids"),
        F.col("parts.length").alias("lengths"),
    )
