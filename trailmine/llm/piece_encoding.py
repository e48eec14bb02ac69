"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text is normalised (identity, blanks written as U+2581, one put in front) and cut into
chunks between which the vocabulary has no merge: before a blank that follows another
character, and around characters that stand in no longer piece. A chunk starts as its
characters; an agenda ordered by the score of the merged piece, then by place, holds the
adjacent pairs that the vocabulary can merge. The best pair is merged, its neighbours give
new pairs, and entries of symbols that have gone are passed over. Characters without a
piece become bytes.

Many chunks of one length are merged at once, as rows of a matrix: each step takes the best
entry of every row's agenda. Long chunks and those with characters without a piece have an
agenda of their own, a heap. Chunks recur, so each worker keeps those it has encoded, up to a number of entries. Every
new chunk, and one whole text of every slice of an Arrow batch, chosen by its hash, are
compared with the sentencepiece library; a difference raises an error. Decoding is the
library's.

Null and empty texts give no pieces, only the begin and end ids if asked for. A model that
this method does not cover (other normalisation, other model type, pieces given by the
user) is refused.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2

from trailmine.llm.text import slices, widened

BLANK = "▁"
KEPT_CHUNKS = 300_000  # encoded chunks a worker keeps
ROW_LENGTH = 32  # characters of the longest chunk merged as a row
_NONE = np.int32(1 << 30)
_NORMAL, _USER, _BYTE = 1, 4, 6


class PieceEncoder:
    """Encoder of one model; ids as little-endian unsigned 32-bit integers."""

    def __init__(self, model: bytes) -> None:
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        norm, trainer = proto.normalizer_spec, proto.trainer_spec
        plain = norm.name == "identity" and norm.add_dummy_prefix and norm.escape_whitespaces
        if not plain or norm.remove_extra_whitespaces or trainer.model_type != 2 or not trainer.byte_fallback:
            raise ValueError("only merge models with identity normalisation and byte fallback are covered")
        if trainer.treat_whitespace_as_suffix or any(p.type == _USER for p in proto.pieces):
            raise ValueError("models with blanks as suffixes or pieces given by the user are not covered")
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.begin, self.end = (np.array([i], "<u4").tobytes() for i in (self.library.bos_id(), self.library.eos_id()))
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == _NORMAL}
        self.scores = {p.piece: p.score for p in proto.pieces if p.type == _NORMAL}
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == _BYTE}
        self.border = ""  # a character at which chunks end, if there is one
        self.cut = self._chunks(proto)
        self.kept: dict[str, bytes] = {}
        self._tables()

    def _tables(self) -> None:
        """Character ids, and for each pair of pieces the piece it makes, with its rank by score."""
        self.characters = np.full(0x110000, -1, np.int32)
        made = []
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.characters[ord(piece)] = i
            for k in range(1, len(piece)):
                left, right = self.ids.get(piece[:k]), self.ids.get(piece[k:])
                if left is not None and right is not None:
                    made.append((left << 32 | right, i))
        made.sort()
        self.pairs, self.made = np.array([p for p, _ in made], np.int64), np.array([m for _, m in made], np.int32)
        levels = {x: r for r, x in enumerate(sorted(set(self.scores.values()), reverse=True))}
        self.rank = np.zeros(max(self.ids.values()) + 1, np.int32)
        for piece, i in self.ids.items():
            self.rank[i] = levels[self.scores[piece]]

    def _pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of pairs; a pair without a piece has no rank."""
        wanted = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        known = self.pairs[at] == wanted
        piece = np.where(known, self.made[at], 0)
        return np.where(known, self.rank[piece], _NONE), piece

    def _merge_rows(self, chunks: list[str], symbols: np.ndarray) -> None:
        """Keep the ids of chunks of one length, given as rows of character ids."""
        rows = np.arange(len(chunks))
        rank, piece = self._pair(symbols[:, :-1], symbols[:, 1:])
        while True:
            width = symbols.shape[1]
            best = rank.argmin(1) if width > 1 else np.zeros(len(rows), np.int64)
            each = np.arange(len(rows))
            open_ = rank[each, best] < _NONE if width > 1 else np.zeros(len(rows), bool)
            packed = symbols[~open_].astype("<u4").tobytes()
            for k, row in enumerate(rows[~open_].tolist()):
                self.kept[chunks[row]] = packed[k * width * 4 : (k + 1) * width * 4]
            if not open_.any():
                return
            rows, best, symbols, rank, piece = rows[open_], best[open_], symbols[open_], rank[open_], piece[open_]
            each = np.arange(len(rows))
            symbols[each, best] = piece[each, best]
            later = np.arange(width - 1)
            later = later + (later > best[:, None])
            symbols = np.take_along_axis(symbols, later, 1)
            if width > 2:
                # The pair at best goes; the pairs on both sides of the new piece are looked up anew.
                beside = np.arange(width - 2)
                beside = beside + (beside >= best[:, None])
                rank, piece = np.take_along_axis(rank, beside, 1), np.take_along_axis(piece, beside, 1)
                for place in (best - 1, best):
                    inside = np.flatnonzero((place >= 0) & (place < width - 2))
                    at = place[inside]
                    rank[inside, at], piece[inside, at] = self._pair(symbols[inside, at], symbols[inside, at + 1])
            else:
                rank = piece = np.zeros((len(rows), 0), np.int32)

    def keep(self, chunks: set[str]) -> None:
        """Encode chunks and keep them."""
        by_length: dict[int, list[str]] = {}
        for chunk in chunks:
            by_length.setdefault(len(chunk), []).append(chunk)
        for length, own in by_length.items():
            if length <= ROW_LENGTH:
                codes = np.frombuffer("".join(own).encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, length)
                symbols = self.characters[codes]
                whole = (symbols >= 0).all(1)
                self._merge_rows([c for c, w in zip(own, whole.tolist()) if w], symbols[whole])
                own = [c for c, w in zip(own, whole.tolist()) if not w]
            for chunk in own:
                self.kept[chunk] = self._heap_ids(chunk)
        self.compare_chunks(list(chunks))

    def _chunks(self, proto) -> Callable[[str], list[str]]:
        long = [p for p in self.ids if len(p) > 1]
        joined = set("".join(long))
        if any(BLANK in p.lstrip(BLANK) for p in long):
            return lambda text: [text]
        apart = [c for c in "\n\t\r" if c not in joined]
        self.border = "".join(apart[:1])
        alone = "".join(re.escape(c) for c in apart)
        inner = f"[^{BLANK}{alone}]+"
        return re.compile(f"{BLANK}+(?:{inner})?|{inner}" + (f"|[{alone}]" if alone else "")).findall

    def merge(self, chunk: str) -> list[str]:
        """Pieces of a chunk by the agenda."""
        scores = self.scores
        pieces: list[str | None] = list(chunk)
        n = len(pieces)
        if n == 1:
            return [chunk]
        following, preceding = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            pair = chunk[i : i + 2]
            if pair in scores:
                agenda.append((-scores[pair], i, i + 1, pair))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, pair = heapq.heappop(agenda)
            a, b = pieces[left], pieces[right]
            if a is None or b is None or len(a) + len(b) != len(pair) or following[left] != right:
                continue
            pieces[left], pieces[right] = pair, None
            after = following[left] = following[right]
            if after < n:
                preceding[after] = left
                wider = pair + pieces[after]
                if wider in scores:
                    heapq.heappush(agenda, (-scores[wider], left, after, wider))
            before = preceding[left]
            if before >= 0:
                wider = pieces[before] + pair
                if wider in scores:
                    heapq.heappush(agenda, (-scores[wider], before, left, wider))
        return [p for p in pieces if p is not None]

    def _heap_ids(self, chunk: str) -> bytes:
        ids: list[int] = []
        for piece in self.merge(chunk):
            known = self.ids.get(piece)
            if known is None:
                ids.extend(self.bytes[b] for b in piece.encode())
            else:
                ids.append(known)
        return np.array(ids, "<u4").tobytes()

    def compare_chunks(self, chunks: list[str]) -> None:
        """Behind a border the library adds no blank of its own; without borders every chunk begins with that blank."""
        border = self.border
        front = len(self.library.encode(border))
        texts = [(border + c if border else c[1:]).replace(BLANK, " ") for c in chunks]
        for chunk, told in zip(chunks, self.library.encode(texts, num_threads=1)):
            if np.array(told[front:], "<u4").tobytes() != self.kept[chunk]:
                raise ValueError(f"pieces of {chunk!r} differ from the library's")

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, without begin and end."""
        cut = [self.cut(BLANK + t.replace(" ", BLANK)) if t else [] for t in texts]
        if len(self.kept) > KEPT_CHUNKS:
            self.kept.clear()
        self.keep(set().union(*cut).difference(self.kept))
        return [b"".join([self.kept[c] for c in chunks]) for chunks in cut]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def compare(self, text: str, packed: bytes) -> None:
        if np.frombuffer(packed, "<u4").tolist() != self.library.encode(text):
            raise ValueError("ids of a text differ from the library's")


_ENCODERS: dict[bytes, PieceEncoder] = {}


def encoder_of(model: bytes) -> PieceEncoder:
    """The encoder of a model, one in each worker."""
    digest = hashlib.sha256(model).digest()
    if digest not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[digest] = PieceEncoder(model)
    return _ENCODERS[digest]


def _encode(model, add_begin: bool, add_end: bool, decode: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(model.value)
        for batch in slices(batches, "text"):
            tokens, decoded = [], []
            texts = [t or "" for t in batch.column("text").to_pylist()]
            packed_texts = encoder.encode_all(texts)
            if any(texts):
                chosen = min((i for i, t in enumerate(texts) if t), key=lambda i: zlib.crc32(texts[i].encode()))
                encoder.compare(texts[chosen], packed_texts[chosen])
            for packed in packed_texts:
                packed = (encoder.begin if add_begin else b"") + packed + (encoder.end if add_end else b"")
                tokens.append(packed)
                if decode:
                    decoded.append(encoder.library.decode(np.frombuffer(packed, "<u4").tolist()))
            batch = batch.append_column("token_bytes", pa.array(tokens, pa.binary()))
            if decode:
                batch = batch.append_column("decoded", pa.array(decoded, pa.string()))
            yield batch

    return encode


def encode_pieces(docs: DataFrame, model_path: str, add_begin: bool = True, add_end: bool = True, decode: bool = False) -> DataFrame:
    """``docs`` with ``token_bytes`` and, if asked for, ``decoded``; columns of these names are replaced.

    ``token_bytes`` holds the ids as little-endian unsigned 32-bit integers.
    The model is read on the driver and sent to the executors.
    """
    docs = docs.drop("token_bytes", "decoded")
    model = docs.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())
    added = "token_bytes binary, decoded string" if decode else "token_bytes binary"
    return docs.mapInArrow(_encode(model, add_begin, add_end, decode), widened(docs, added))


def decode_pieces(docs: DataFrame, model_path: str) -> DataFrame:
    """``docs`` with ``decoded``, the text of ``token_bytes``; null where these are null."""
    docs = docs.drop("decoded")
    model = docs.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = encoder_of(model.value).library
        for batch in batches:
            packed = batch.column("token_bytes").to_pylist()
            texts = [None if p is None else library.decode(np.frombuffer(p, "<u4").tolist()) for p in packed]
            yield batch.append_column("decoded", pa.array(texts, pa.string()))

    return docs.mapInArrow(decode, widened(docs, "decoded string"))
