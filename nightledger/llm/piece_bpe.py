"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text is normalized (a space becomes U+2581, one is put in front), cut into
chunks, and each chunk is merged by an agenda: adjacent symbol pairs ordered by
the score of their union, ties from the left. Taking the best pair merges it
and offers the two pairs it now takes part in. The agendas of many short chunks
are the rows of one matrix: a step takes the best pair of every row. A long
chunk has a heap; pairs whose symbols have changed since are skipped.
Characters without a piece become byte pieces.

Chunks: no piece of the vocabulary has a U+2581 behind another character, and
none of several characters holds a line feed, so no merge can cross from a
letter to the next U+2581 or past a line feed. Both facts are checked when
the model is loaded; chunks are then independent and their results are kept
in a bounded table.

Each Arrow batch is checked against the sentencepiece library: every chunk
that the worker meets for the first time (many to a call, a line each, as line
feeds bound chunks), and one whole text with its decoded form. A difference
raises. Within a chunk, two characters that no piece has side by side bound two
parts that merge on their own. A chunk's ids are decoded when it is learned: its
byte pieces are whole characters, so a text's decoded form is that of its
chunks, joined; chunks whose decoded form is not their own text are remembered
with it.

Defined results: null is read as an empty text; an empty text has no tokens;
U+2581 in a text comes back as a space, as in the library.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.llm.common import held, ready, small_batches

SPACE = "▁"
CHUNKS = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
PROBES = ("", " ", "a", " a  b ", "½ ﬁ", "Á\t\u3000x", "\n a\r\n", "\x00\x7f\ufeff", f"a{SPACE}b")
SHORT = 48  # symbols up to which a plain list serves as agenda
CHECKED = 500  # chunks in one call of the library
AT_ONCE = 100_000  # chunks of texts that are encoded together


class Codec:
    """Encoder and decoder of one model file. Ids travel as strings of chr(id)."""

    kept = 350_000  # chunks remembered, and parts of chunks

    def __init__(self, model_path: str):
        import sentencepiece
        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = [lib.id_to_piece(i) for i in range(lib.vocab_size())]
        special = {i for i in range(len(pieces)) if lib.is_control(i) or lib.is_unknown(i)}
        self.byte = {int(p[3:5], 16): chr(i) for i, p in enumerate(pieces) if lib.is_byte(i)}
        self.byte_of = {c: b for b, c in self.byte.items()}
        self.ids = {p: chr(i) for i, p in enumerate(pieces) if i not in special and chr(i) not in self.byte_of}
        self.scores = {p: lib.get_score(ord(c)) for p, c in self.ids.items()}
        self.inside = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.pieces, self.parts = {chr(i): p for i, p in enumerate(pieces)}, {}
        self.cache, self.read = {}, {}   # chunk -> ids, and -> decoded form where that is not the chunk's own text
        if any(lib.is_unused(i) for i in range(len(pieces))) or len(self.byte) != 256:
            raise ValueError("the model has unused pieces or no byte fallback")
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.ids):
            raise ValueError("pieces of the model cross chunk boundaries")
        for p in PROBES:
            if lib.normalize(p) != self.normalized(p) or self.encode(p) != lib.encode(p):
                raise ValueError("the model normalizes texts in another way")
        self._tables()

    def _tables(self) -> None:
        """Arrays of the matrix: the symbol of each character, and for each pair of symbols that make a piece the piece and its score."""
        n = self.library.vocab_size()
        self.symbol = np.arange(0x110000, dtype=np.int64) + n   # a character without a piece is a symbol beyond the vocabulary
        pairs = {}
        for p, c in self.ids.items():
            if len(p) == 1:
                self.symbol[ord(p)] = ord(c)
            for i in range(1, len(p)):
                left, right = self.ids.get(p[:i]), self.ids.get(p[i:])
                if left and right:
                    pairs[ord(left) * n + ord(right)] = ord(c)
        if any(self.ids.get(x) is None for p in self.ids for x in p):
            raise ValueError("the model has pieces of characters that are no pieces")
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_piece = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        self.piece_score = np.full(n, -np.inf)
        for p, c in self.ids.items():
            self.piece_score[ord(c)] = self.scores[p]

    def _unions(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(piece, score) of each pair of symbols; -inf where they make none. Symbols below 0 are none."""
        n = len(self.piece_score)
        key = np.where((left >= 0) & (right >= 0) & (left < n) & (right < n), left * n + right, -1)
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        piece = self.pair_piece[at]
        return piece, np.where(self.pair_keys[at] == key, self.piece_score[piece], -np.inf)

    def merged_many(self, chunks: list[str]) -> list[str]:
        """Ids of each chunk; short ones by rows of a matrix, those of like length together."""
        out: list[str | None] = [None] * len(chunks)
        of_width: dict[int, list[int]] = {}
        for i, c in enumerate(chunks):
            of_width.setdefault(-(-len(c) // 8) * 8 if len(c) <= SHORT else 0, []).append(i)
        for width, rows in of_width.items():
            for at in range(0, len(rows), 4096):
                some = rows[at:at + 4096]
                made = self._by_rows([chunks[i] for i in some], width) if width else [self.merged(chunks[i]) for i in some]
                for i, ids in zip(some, made, strict=True):
                    out[i] = ids
        return out

    def _by_rows(self, chunks: list[str], width: int) -> list[str]:
        """The agendas of all chunks, a step of each at a time."""
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        place = np.arange(width)
        symbols = np.full((len(chunks), width), -1, np.int64)
        symbols[place[None] < lengths[:, None]] = self.symbol[np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), "<u4")]
        if width < 2:
            return self._said(symbols)
        union, score = self._unions(symbols[:, :-1], symbols[:, 1:])
        rows = np.arange(len(chunks))       # rows with pairs left, and their agendas
        now = symbols
        while True:
            best = score.argmax(axis=1)     # the first of equal scores
            go = score[np.arange(len(rows)), best] > -np.inf
            if not go.all():
                symbols[rows[~go]] = now[~go]
                rows, now, union, score, best = rows[go], now[go], union[go], score[go], best[go]
            if not len(rows):
                return self._said(symbols)
            each = np.arange(len(rows))
            behind = place[None, :-1] > best[:, None]
            now[each, best] = union[each, best]
            now[:, :-1][behind] = now[:, 1:][behind]
            now[:, -1] = -1
            behind = behind[:, :-1]
            union[:, :-1][behind] = union[:, 1:][behind]
            score[:, :-1][behind] = score[:, 1:][behind]
            score[:, -1] = -np.inf
            for i in (best - 1, best):      # the two pairs that the new symbol is in
                ok = (i >= 0) & (i < width - 1)
                r, i = each[ok], i[ok]
                union[r, i], score[r, i] = self._unions(now[r, i], now[r, i + 1])

    def _said(self, symbols: np.ndarray) -> list[str]:
        """Rows of symbols as strings of ids."""
        n, held = len(self.piece_score), symbols >= 0
        flat, ends = symbols[held], np.cumsum(held.sum(axis=1)).tolist()
        if (flat < n).all():
            text = flat.astype("<u4").tobytes().decode("utf-32-le")
            return [text[a:b] for a, b in zip([0, *ends], ends)]  # noqa: B905
        byte = self.byte
        one = [chr(x) if x < n else "".join([byte[b] for b in chr(x - n).encode("utf-8", "surrogatepass")]) for x in flat.tolist()]
        return ["".join(one[a:b]) for a, b in zip([0, *ends], ends)]  # noqa: B905

    @staticmethod
    def normalized(text: str) -> str:
        return SPACE + text.replace(" ", SPACE) if text else ""

    def merged(self, chunk: str) -> str:
        """Ids of one chunk: no merge joins two characters that no piece has side by side."""
        at, inside, parts = 0, self.inside, []
        for i in range(1, len(chunk)):
            if chunk[i - 1:i + 1] not in inside:
                parts.append(chunk[at:i])
                at = i
        parts.append(chunk[at:])
        known, out = self.parts, []
        for p in parts:
            ids = known.get(p)
            if ids is None:
                if len(known) >= self.kept:
                    known.clear()
                ids = known[p] = self._part(p)
            out.append(ids)
        return "".join(out)

    def _part(self, chunk: str) -> str:
        """Ids of a part of a chunk by the agenda."""
        out = self._by_list(chunk) if len(chunk) <= SHORT else self._by_heap(chunk)
        ids, byte = self.ids, self.byte
        return "".join([ids.get(s) or "".join([byte[b] for b in s.encode()]) for s in out])

    def _by_list(self, chunk: str) -> list[str]:
        """Short chunks: the agenda is the list of pair scores in text order."""
        score, none = self.scores.get, -float("inf")
        symbols = list(chunk)
        agenda = [score(a + b, none) for a, b in zip(symbols, symbols[1:])]  # noqa: B905
        while agenda and (best := max(agenda)) > none:
            i = agenda.index(best)
            symbols[i] += symbols.pop(i + 1)
            del agenda[i]
            if i < len(agenda):
                agenda[i] = score(symbols[i] + symbols[i + 1], none)
            if i:
                agenda[i - 1] = score(symbols[i - 1] + symbols[i], none)
        return symbols

    def _by_heap(self, chunk: str) -> list[str]:
        """Long chunks: a heap; pairs whose symbols have changed since are skipped."""
        score = self.scores.get
        symbols, n = list(chunk), len(chunk)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda: list[tuple[float, int, int, str]] = []

        def offer(i, j):
            if i >= 0 and j < n and (s := score(symbols[i] + symbols[j])) is not None:
                heapq.heappush(agenda, (-s, i, j, symbols[i] + symbols[j]))
        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, i, j, union = heapq.heappop(agenda)
            if not symbols[i] or not symbols[j] or len(symbols[i]) + len(symbols[j]) != len(union):
                continue
            symbols[i], symbols[j] = union, ""
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [s for s in symbols if s]

    def learn(self, keys: list[str]) -> tuple[dict[str, str], dict[str, str]]:
        """Encode and decode new chunks and hold them against the library."""
        new = self.merged_many(keys)
        feed = self.byte[10]
        for i in range(0, len(keys), CHECKED):
            some, own = keys[i:i + CHECKED], new[i:i + CHECKED]
            # behind a line feed a chunk stands alone: the front piece and the line feed go
            theirs = self.library.encode("\n" + "\n".join(some).replace(SPACE, " "))[2:]
            if list(map(ord, feed.join(own))) != theirs:
                for c, ids in zip(some, own, strict=True):
                    if list(map(ord, ids)) != (one := self.library.encode("\n" + c.replace(SPACE, " "))[2:]):
                        raise AssertionError(f"the library encodes {c!r} as {one}, not {list(map(ord, ids))}")
                raise AssertionError("the library does not part chunks at line feeds")
        if len(self.cache) + len(new) > self.kept:
            self.cache, self.read = {}, {}
        ids = dict(zip(keys, new, strict=True))
        read = {c: d for c, d in zip(keys, map(self._joined, new), strict=True) if d != c.replace(SPACE, " ")}
        self.cache.update(ids)
        self.read.update(read)
        return ids, read

    @staticmethod
    def chunks(text: str) -> list[str]:
        """The chunks of a text in order."""
        if SPACE in text or "  " in text or "\n " in text or " \n" in text or text[:1] == " " or text[-1:] == " ":
            return CHUNKS.findall(Codec.normalized(text))
        out = []  # single spaces only: the same, faster
        for line in text.split("\n"):
            words = line.replace(" ", " " + SPACE).split(" ")
            if out:
                out.append("\n")
                if not line:
                    continue
            else:
                words[0] = SPACE + words[0]
            out += words
        return out if text else []

    def known(self, chunks: set[str]) -> tuple[dict[str, str], dict[str, str]]:
        """Tables that hold all of ``chunks``: ids, and decoded forms other than the chunk's own text."""
        ids, read = self.cache, self.read
        new = chunks.difference(ids)
        if new:
            fresh, decoded = self.learn(sorted(new))
            if self.cache is not ids:  # forgotten in between
                old = chunks - new
                return fresh | {c: ids[c] for c in old}, decoded | {c: read[c] for c in old if c in read}
        return ids, read

    @staticmethod
    def said(chunks: list[str], read: dict[str, str]) -> str:
        """The decoded form of chunks in order."""
        if read.keys().isdisjoint(chunks):
            return "".join(chunks).replace(SPACE, " ")
        return "".join([read[c] if c in read else c.replace(SPACE, " ") for c in chunks])

    def encode_batch(self, texts: list[str]) -> list[str]:
        return [ids for ids, _ in self.both(texts)]

    def both(self, texts: list[str]) -> list[tuple[str, str]]:
        """(ids, decoded form) of each text; new chunks of many texts are learned together."""
        out, some, n = [], [], 0

        def done():
            ids, read = self.known(set().union(*some))
            out.extend([("".join(map(ids.__getitem__, c)), self.said(c, read).removeprefix(" ")) for c in some])
            some.clear()
        for text in texts:
            chunks = self.chunks(text)
            if len(chunks) > AT_ONCE:  # a text may have more chunks than are remembered
                parts = [chunks[i:i + AT_ONCE] for i in range(0, len(chunks), AT_ONCE)]
                done()
                said = []
                for part in parts:
                    ids, read = self.known(set(part))
                    said.append(("".join(map(ids.__getitem__, part)), self.said(part, read)))
                out.append(("".join(i for i, _ in said), "".join(d for _, d in said).removeprefix(" ")))
                n = 0
                continue
            some.append(chunks)
            n += len(chunks)
            if n > AT_ONCE:
                done()
                n = 0
        done()
        return out

    def encode(self, text: str) -> list[int]:
        return [ord(x) for c in CHUNKS.findall(self.normalized(text)) for x in self.merged(c)]

    def _joined(self, ids: str) -> str:
        """Pieces joined, byte pieces as UTF-8, U+2581 as spaces."""
        byte_of, pieces = self.byte_of, self.pieces
        if byte_of.keys().isdisjoint(ids):
            text = "".join(map(pieces.__getitem__, ids))
        else:
            text = b"".join([bytes((byte_of[i],)) if i in byte_of else pieces[i].encode() for i in ids]).decode("utf-8", "replace")
        return text.replace(SPACE, " ")

    def decode(self, ids: str) -> str:
        """The text of any ids: without the space in front."""
        return self._joined(ids).removeprefix(" ")


def codec(model_path: str) -> Codec:
    """One per worker process and model, kept until the worker needs another."""
    return held(f"codec {model_path}", lambda: Codec(model_path))


def encode_decode(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids array<int>, decoded) of every whole text."""
    ready(docs.sparkSession)
    small_batches(docs.sparkSession)

    def each(batches):
        from nightledger.llm.piece_bpe import codec  # the worker's own, kept between tasks
        c = codec(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # a bounded number of texts at a time
                part = batch.slice(at, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids, decoded = zip(*c.both(texts), strict=True)
                if not at:
                    whole = min(range(len(texts)), key=lambda i: (not texts[i], len(texts[i])))
                    theirs = c.library.encode(texts[whole])
                    if theirs != list(map(ord, ids[whole])) or c.library.decode(theirs) != decoded[whole]:
                        raise AssertionError(f"the library reads {texts[whole]!r} in another way")
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                flat = np.frombuffer("".join(ids).encode("utf-32-le", "surrogatepass"), "<i4")
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(ends, pa.array(flat, pa.int32())), pa.array(decoded, pa.string())],
                    ["doc_id", "ids", "decoded"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(each, "doc_id long, ids array<int>, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of the operator's output."""
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
