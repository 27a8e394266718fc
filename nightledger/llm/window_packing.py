"""Documents into token windows by sum-of-squares online packing.

A document is its token ids and one closing id. Whole windows are cut off its
front; what is left is an item that goes, as it comes, to one of the fill
levels at which a window is open, or to a new window: the level that makes the
sum of the squared counts of partially filled windows least (the fuller one of
equal choices). The counts are one array by fill level, the open windows of a
level a stack, so a placement looks at one array and never at other documents.

Cuts: an item may be cut. That happens only where ``most_open`` windows are
open and the rule asks for another one (the item's head then fills the fullest
window), and when a task ends: its open windows are poured together, and the
one that stays below the window size is cut into sequences of powers of two.
So nothing is padded, whatever the lengths are.

A task packs the documents of its partition and holds ``most_open`` windows at
most; nothing is shuffled, and a task that is run again makes the same
sequences (ids are the partition's place and a counter).

Tokens are those of the ``tokenizers`` library. A boundary between two of its
words always lies before white space that follows something else, so texts
are cut there and each distinct cut is encoded once and remembered in a
bounded table. New cuts of Latin letters go, joined to long strings, to
``tiktoken`` over the same vocabulary, which merges three to five times as
fast; their ids are dealt to the cuts by the bytes they stand for, which has to
come out even. Other cuts and those with a special token go to the library, and
texts with U+001C to U+001F, which are white space to some and not to others,
go there whole. One whole text of every batch is held against the library. A
difference raises.

Defined results: null is read as an empty text, which has the closing id
alone; a null id stays; rows that repeat an id are documents of their own;
other columns are ignored. No rows give no pieces.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.llm.common import ready

WINDOW, CLOSING, MOST_OPEN = 1024, 0, 256
CUTS, UNSURE = re.compile(r"\s*\S+|\s+"), re.compile("[\x1c-\x1f]")
JOINED = re.compile("[ \\n\\t\\r]+[\\x21-\\u024f]*[\\x21-\\x7e\\xa1-\\u024f]")   # cuts whose letters and signs mean the same to every library
# fixed values: what parts a text into words before byte pairs are merged
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PROBES = ("", " ", "a", " a  b\n\n c\t", "it's 12,3  x", "é  😀\r\n", "<|endoftext|> a")
ID_BYTES = 4   # ids are little-endian unsigned 32-bit numbers


class Words:
    """Texts -> bytes of their ids, by a tokenizer file."""

    kept = 500_000    # cuts remembered
    joined = 2_000    # cuts in one string for the library
    at_once = 200_000  # cuts of texts that are looked up together

    def __init__(self, path: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        import tiktoken
        from tokenizers import Tokenizer
        self.library, self.known = Tokenizer.from_file(path), {}
        special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.special = re.compile("|".join(map(re.escape, special)) or "(?!)")
        # a token's characters stand for bytes: printable ones for themselves, the others for 256, 257, ... in order
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(own)))}
        ranks = {bytes(map(byte.__getitem__, t)): i for t, i in self.library.get_vocab(with_added_tokens=False).items() if t not in special}
        self.fast = tiktoken.Encoding("own", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = np.zeros(max(ranks.values()) + 1, np.int64)
        self.bytes_of[list(ranks.values())] = list(map(len, ranks))
        for p, ids in zip(PROBES, self.batch(list(PROBES)), strict=True):
            if ids != self.whole(p):
                raise ValueError(f"the tokenizer has words that cross white space: {p!r}")

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, new: list[str]) -> None:
        """Encode new cuts."""
        same, special = JOINED.fullmatch, self.special.search
        chain = [c for c in new if same(c) and not special(c)]
        alone = list(set(new).difference(chain))
        for c, e in zip(alone, self.library.encode_batch_fast(alone, add_special_tokens=False), strict=True):
            self.known[c] = np.array(e.ids, "<u4").tobytes()
        for at in range(0, len(chain), self.joined):
            part = chain[at:at + self.joined]
            ids = np.array(self.fast.encode_ordinary("".join(part)), "<u4")
            ends = np.cumsum(self.bytes_of[ids])
            cuts = np.cumsum(np.fromiter([len(c.encode()) for c in part], np.int64, len(part)))
            to = np.searchsorted(ends, cuts)
            if (ends[to] != cuts).any():
                raise AssertionError("words cross a cut")
            flat, ends = ids.tobytes(), ((to + 1) * ID_BYTES).tolist()
            self.known.update(zip(part, [flat[a:b] for a, b in zip([0, *ends], ends)], strict=True))  # noqa: B905

    def _look_up(self, texts: list[list[str]]) -> list[bytes]:
        """Ids of texts that are cut already."""
        new = set().union(*texts).difference(self.known)
        if len(self.known) + len(new) > self.kept:
            self.known.clear()
            new = set().union(*texts)
        self._learn(list(new))
        return [b"".join(map(self.known.__getitem__, cuts)) for cuts in texts]

    def batch(self, texts: list[str]) -> list[bytes]:
        out, some, n = [], [], 0
        for text in texts:
            if UNSURE.search(text):
                out += self._look_up(some)
                some, n = [], 0
                out.append(self.whole(text))
                continue
            cuts = CUTS.findall(text)
            if len(cuts) > self.at_once:   # one very long text, a part at a time
                out += self._look_up(some)
                some, n = [], 0
                out.append(b"".join([self._look_up([cuts[i:i + self.at_once]])[0] for i in range(0, len(cuts), self.at_once)]))
                continue
            some.append(cuts)
            n += len(cuts)
            if n > self.at_once:
                out += self._look_up(some)
                some, n = [], 0
        return out + self._look_up(some)


_WORDS: dict[str, Words] = {}


def words(path: str) -> Words:
    """One per worker process and file."""
    if path not in _WORDS:
        _WORDS[path] = Words(path)
    return _WORDS[path]


class Packer:
    """Windows of one task. Pieces are (document, start, ids as bytes, tokens of the document)."""

    def __init__(self, window: int, first: int, most_open: int):
        self.window, self.next, self.most = window, first, most_open
        self.count = np.zeros(window + 1, np.int64)   # the level array: open windows by fill
        self.open: list[list] = [[] for _ in range(window)]
        self.n_open, self.closed = 0, []

    def _close(self, pieces: list) -> None:
        offset = 0
        for doc, start, ids, tokens in pieces:
            n = len(ids) // ID_BYTES
            self.closed.append((doc, start, n, ids, tokens, self.next, offset))
            offset += n
        self.next += 1

    def _level(self, size: int) -> int:
        """The fill level (0: a new window) after which the squared counts sum to the least."""
        w, n = self.window, self.count
        change = 2 * n[size:w + 1] + 1            # the window's new level ...
        change[-1] = 0                            # ... is none if it is full
        change[1:] -= 2 * n[1:w + 1 - size] - 1   # and it leaves its old one
        change[1:][n[1:w + 1 - size] == 0] = np.iinfo(np.int64).max
        return int(len(change) - 1 - np.argmin(change[::-1]))

    def _put(self, level: int, piece: tuple) -> None:
        pieces = []
        if level:
            pieces = self.open[level].pop()
            self.count[level] -= 1
            self.n_open -= 1
        pieces.append(piece)
        fill = level + len(piece[2]) // ID_BYTES
        if fill == self.window:
            self._close(pieces)
        else:
            self.open[fill].append(pieces)
            self.count[fill] += 1
            self.n_open += 1

    def add(self, doc, ids: bytes) -> None:
        tokens, step, at = len(ids) // ID_BYTES, self.window * ID_BYTES, 0
        while len(ids) - at >= step:
            self._close([(doc, at // ID_BYTES, ids[at:at + step], tokens)])
            at += step
        while size := (len(ids) - at) // ID_BYTES:
            level, end = self._level(size), len(ids)
            if not level and self.n_open >= self.most:
                level = int(np.flatnonzero(self.count)[-1])
                end = min(end, at + (self.window - level) * ID_BYTES)
            self._put(level, (doc, at // ID_BYTES, ids[at:end], tokens))
            at = end

    def finish(self) -> None:
        """Pour the open windows together; the last one becomes sequences of powers of two."""
        left = [p for level in reversed(self.open) for pieces in level for p in pieces]
        sizes, rest = [], sum(len(p[2]) for p in left) // ID_BYTES
        while rest:
            n = self.window if rest >= self.window else 1 << (rest.bit_length() - 1)
            sizes.append(n)
            rest -= n
        left.reverse()
        for n in sizes:
            pieces = []
            while n:
                doc, start, ids, tokens = left.pop()
                k = min(n, len(ids) // ID_BYTES)
                if k * ID_BYTES < len(ids):
                    left.append((doc, start + k, ids[k * ID_BYTES:], tokens))
                pieces.append((doc, start, ids[:k * ID_BYTES], tokens))
                n -= k
            self._close(pieces)


KINDS = {"doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids": pa.binary(), "doc_tokens": pa.int64(),
         "sequence_id": pa.int64(), "offset": pa.int64()}


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, most_open: int = MOST_OPEN) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset) of every piece of every document.

    ``ids`` are little-endian unsigned 32-bit numbers.
    """
    ready(docs.sparkSession)
    closing = np.array([CLOSING], "<u4").tobytes()

    def rows(packer):
        out, packer.closed = packer.closed, []
        for at in range(0, len(out), 4096):
            columns = zip(*out[at:at + 4096], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, KINDS.values(), strict=True)], list(KINDS))

    def each(batches):
        from nightledger.llm.window_packing import words  # the worker's own, kept between tasks
        encoded, packer = words(tokenizer), None
        for batch in batches:
            if not batch.num_rows:
                continue
            if packer is None:
                packer = Packer(window, batch.column(2)[0].as_py() << 32, most_open)
            checked = False
            for at in range(0, batch.num_rows, 256):  # a bounded number of texts at a time
                part = batch.slice(at, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                if not checked:
                    text = min(texts, key=lambda t: (not t, len(t)))
                    if encoded.batch([text])[0] != encoded.whole(text):
                        raise AssertionError(f"the library reads {text!r} in another way")
                    checked = True
                for doc, ids in zip(part.column(0).to_pylist(), encoded.batch(texts), strict=True):
                    packer.add(doc, ids + closing)
                yield from rows(packer)
        if packer is not None:
            packer.finish()
            yield from rows(packer)
    return docs.select(F.col("doc_id").cast("long"), "text", F.spark_partition_id().cast("long").alias("part")).mapInArrow(
        each, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def sequences(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """(sequence_id, ids, length, padding): the pieces of each sequence joined.

    A sequence is padded to the window unless its length is a power of two.
    """
    joined = F.aggregate(F.array_sort(F.collect_list(F.struct("offset", "ids"))), F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    length = F.octet_length("ids").cast("long") / ID_BYTES
    return (pieces.groupBy("sequence_id").agg(joined.alias("ids"))
            .withColumn("length", length.cast("long"))
            .withColumn("padding", F.when(F.bit_count("length") == 1, F.lit(0)).otherwise(F.lit(window) - F.col("length")).cast("long")))


def digests(pieces: DataFrame) -> DataFrame:
    """The operator's output with a checksum in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
