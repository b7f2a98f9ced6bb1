"""Best-fit packing of tokenised documents into sequences, online and in bounded space.

A packer keeps a fixed number of open sequences, listed by free space; a bitset
has a bit for every free space that some open sequence has. A piece goes to the
open sequence with the least free space that still holds it (one shift and the
lowest set bit). If none does, a new sequence opens, and when too many are open
the fullest closes first. Space is bounded by the number of open sequences, not
by the input.

Pieces are dealt to packers by hash, so that each sees the same mix of lengths;
the number of packers follows the number of tokens. A packer is online: pieces
arrive in an order by hash, which has nothing to do with their lengths and which
reruns repeat, and none is put back or moved. A closed sequence takes no more.

Cases: null text is an empty document, which still has its end token; longer
documents are cut into full pieces and a rest; repeated rows are packed one by
one; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factweave.llm.common import pick, stash

SEQUENCE = 4096
#: Words, and pieces of words, whose ids a worker remembers at once; beyond it forgets them and starts anew.
REMEMBERED = 300_000

#: Words of these characters are their own canonical form, and their lower case is found character by character.
_PLAIN = re.compile("[!-~\u00a1-\u012f\u0131-\u017f]+")
#: How the vocabulary cuts words into pieces (fixed value).
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


_MARKS = ".,!?*&%$#;:|"


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes() if sys.byteorder == "big" else array("I", ids).tobytes()


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write each byte as a letter: printable bytes as themselves, the others in order from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in set(printable))
    return {b: chr(b) for b in printable} | {b: chr(0x100 + i) for i, b in enumerate(others)}


class WordTokenizer:
    """Ids of whole texts, word by word.

    The vocabulary drops white space and never merges across it, so a text's ids
    are those of its words in order. Words come again and again, and so do their
    pieces (letters, digits, marks): the ids of both are remembered. Plain words are
    cut into pieces here and each piece goes to the model; any other word (other
    scripts, control characters, special tokens) goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def ids(self, text: bytes) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        words = text.split()
        try:
            return b"".join(map(self.words.__getitem__, words))
        except KeyError:
            pass
        new = set(words).difference(self.words)
        if len(self.words) + len(new) > REMEMBERED:
            self.words.clear()
            new = set(words)
        for word in new:
            self.words[word] = self._word(word.decode())
        return b"".join(map(self.words.__getitem__, words))

    def _word(self, word: str) -> bytes:
        if not _PLAIN.fullmatch(word) or "<|" in word:
            return _packed(self.tokenizer.encode(word, add_special_tokens=False).ids)
        word = word.lower()
        head = word.rstrip(_MARKS)
        if head.isalpha():  # letters, then marks: nearly all words
            tail = word[len(head) :]
            return self._piece(head) + self._piece(tail) if tail else self._piece(head)
        return b"".join(map(self._piece, _PIECES.findall(word)))

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            if len(self.pieces) > REMEMBERED:
                self.pieces.clear()
            letters = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
            ids = self.pieces[piece] = _packed([t.id for t in self.model.tokenize(letters)])
        return ids


@functools.cache
def worker_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer for all tasks of a worker process."""
    return WordTokenizer(path)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, path: str | None = None, end_id: int = 1, sequence: int = SEQUENCE) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document, cut only where it is longer than a sequence."""
    end, size = np.array([end_id], "<u4").tobytes(), 4 * sequence

    def run(batches: Iterator[pa.RecordBatch]):
        tokenizer = worker_tokenizer(path or tokenizer_path())
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in enumerate(batch.column(1)):
                ids = tokenizer.ids(text.as_py() or b"") + end
                rows += [(doc, at // size, at // 4, min(size, len(ids) - at) // 4, zlib.crc32(ids[at : at + size])) for at in range(0, len(ids), size)]
            doc, piece, start, length, crc = (np.array(x, np.int64) for x in zip(*rows)) if rows else [np.zeros(0, np.int64)] * 5
            out = [batch.column(0).take(pa.array(doc)), piece.astype(np.int32), start, length, crc]
            yield pa.RecordBatch.from_arrays([pa.array(x) if isinstance(x, np.ndarray) else x for x in out], ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = pick(docs, doc_id="doc_id", text="text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


class Packer:
    """Online best-fit with at most ``open_bins`` open sequences."""

    def __init__(self, sequence: int, open_bins: int):
        self.sequence, self.open_bins = sequence, open_bins
        self.frees = 0  # bit f is set if a sequence with f free places is open
        self.by_free: list[list[int]] = [[] for _ in range(sequence + 1)]
        self.count = self.opened = 0

    def put(self, length: int) -> tuple[int, int]:
        """The sequence of a piece and its place there.

        Of equally full sequences the one that came to be so last takes the piece, and the first one closes.
        """
        fits = self.frees >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            bins = self.by_free[free]
            number = bins.pop()
            if not bins:
                self.frees ^= 1 << free
            self.count -= 1
        else:
            free, number = self.sequence, self.opened
            self.opened += 1
        left = free - length
        if left:
            if not self.by_free[left]:
                self.frees |= 1 << left
            self.by_free[left].append(number)
            self.count += 1
            if self.count > self.open_bins:
                fullest = (self.frees & -self.frees).bit_length() - 1
                self.by_free[fullest].pop(0)
                if not self.by_free[fullest]:
                    self.frees ^= 1 << fullest
                self.count -= 1
        return number, self.sequence - free


def dealt(cut: DataFrame, packers: int) -> DataFrame:
    """``cut`` in one partition for each packer, in order of arrival, with the packer's number."""
    number = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(packers)).cast("int")
    rows = cut.withColumn("packer", number).withColumn("arrival", F.xxhash64("ids_crc32", "doc_id", "piece"))
    return rows.repartitionById(packers, F.col("packer")).sortWithinPartitions("arrival", "doc_id", "piece", "length", "ids_crc32").drop("arrival")


def pack(docs: DataFrame, path: str | None = None, end_id: int = 1, sequence: int = SEQUENCE, open_bins: int = 128, packer_tokens: int = 32 << 20) -> DataFrame:
    """The pieces of all documents with ``sequence_id`` and ``offset``.

    ``open_bins`` bounds the sequences that a packer holds open, and
    ``packer_tokens`` is the number of tokens for which a further packer is added.
    """
    cut = stash(pieces(docs, path, end_id, sequence), "pieces")
    n_tokens = cut.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    packers = max(1, round(n_tokens / packer_tokens))
    names = cut.columns

    def run(batches: Iterator[pa.RecordBatch]):
        packer = Packer(sequence, open_bins)
        for batch in batches:
            put = [packer.put(n) for n in batch.column(batch.schema.get_field_index("length")).to_pylist()]
            first = pc.shift_left(pc.cast(batch.column(batch.schema.get_field_index("packer")), pa.int64()), 33)
            number, offset = (pa.array([p[i] for p in put], pa.int64()) for i in (0, 1))
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pc.add(first, number), offset], [*names, "sequence_id", "offset"])

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema.fields)
    return dealt(cut, packers).mapInArrow(run, f"{types}, sequence_id long, offset long")
