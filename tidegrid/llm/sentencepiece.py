"""SentencePiece encoding and decoding with a shared-prefix Viterbi.

Texts are cut into marked words: a run of blanks, each a mark, and what follows up to the next blank.  No piece crosses
such a cut, so the best segmentation of a text is that of its words.  The distinct marked words of a block are sorted, which
lays them out as the depth-first order of their trie; forward scores, back pointers and the open paths into the pieces' trie
are kept on a stack, and a word starts from the depth it shares with the one before.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from . import textops as X
from .common import with_kernel

MARK = "▁"
_UNIT = re.compile(r" *[^ ]+| +")
#: Below the lowest piece, for a character that is spelled in byte pieces.
_UNKNOWN_PENALTY = 10.0


class Vocabulary(NamedTuple):
    """Pieces of a model with the mark as a blank, their scores, and the ids of the 256 byte pieces."""

    pieces: tuple[tuple[str, int, float], ...]
    bytes_: tuple[int, ...]
    size: int


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def load_vocabulary(model_file: str | None = None) -> Vocabulary:
    """Read a model file on the driver; its size is that of the vocabulary, whatever the documents.

    Scores of a unigram model are log probabilities and stay.  Those of a merge model are ranks, 0, -1, -2 and so on, whose
    sum means nothing: by Zipf's law a piece's probability is taken as proportional to 1 / (rank + 2).
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file or default_model())
    n, pieces, byte_ids = sp.get_piece_size(), [], {}
    for i in range(n):
        if sp.is_byte(i):
            byte_ids[int(sp.id_to_piece(i)[3:-1], 16)] = i
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            text = sp.id_to_piece(i)
            # pieces with a mark after another character would cross words
            if text and MARK not in text.lstrip(MARK) and " " not in text:
                pieces.append((text.replace(MARK, " "), i, sp.get_score(i)))
    if all(float(score).is_integer() for _, _, score in pieces):
        weight = {i: 1.0 / (rank + 2) for rank, (_, i, _) in enumerate(sorted(pieces, key=lambda p: (-p[2], p[1])))}
        total = sum(weight.values())
        pieces = [(text, i, math.log(weight[i] / total)) for text, i, _ in pieces]
    if len(byte_ids) != 256:
        raise ValueError("the model has no byte pieces, so that it can't spell every text")
    return Vocabulary(tuple(pieces), tuple(byte_ids[b] for b in range(256)), n)


class Segmenter:
    """The pieces as a trie of dictionaries; a node's entry "" holds the id and score of the piece that ends there."""

    def __init__(self, vocabulary: Vocabulary):
        self.root: dict = {}
        for text, i, score in vocabulary.pieces:
            node = self.root
            for c in text:
                node = node.setdefault(c, {})
            node[""] = (i, score)
        self.low = min((p[2] for p in vocabulary.pieces if p[2] > -1e8), default=0.0) - _UNKNOWN_PENALTY
        self.bytes_ = vocabulary.bytes_

    def spelled(self, char: str) -> bytes:
        return np.array([self.bytes_[b] for b in char.encode("utf-8", "surrogatepass")], np.int32).tobytes()

    def encode_sorted(self, words: list[str]) -> dict[str, bytes]:
        """Ids of the best segmentation of each of the sorted words, as int32 bytes.

        Of segmentations with equal scores, the one whose last piece begins first wins.
        """
        root, low = self.root, self.low
        best, back, open_ = [0.0], [(0, b"")], [[]]  # by depth: score, (start, ids) of the last piece, paths not yet ended
        out: dict[str, bytes] = {}
        ids_of: dict[int, bytes] = {}
        previous = ""
        for word in words:
            shared, most = 0, min(len(word), len(previous))
            while shared < most and word[shared] == previous[shared]:
                shared += 1
            del best[shared + 1 :], back[shared + 1 :], open_[shared + 1 :]
            for i in range(shared, len(word)):
                c, top, link, paths = word[i], -1e300, None, []
                for start, node in open_[i]:
                    node = node.get(c)
                    if node is not None:
                        paths.append((start, node))
                        if (end := node.get("")) is not None and (s := best[start] + end[1]) > top:
                            top, link = s, (start, end[0])
                node = root.get(c)
                if node is not None:
                    paths.append((i, node))
                    if (end := node.get("")) is not None and (s := best[i] + end[1]) > top:
                        top, link = s, (i, end[0])
                if node is None or "" not in node:
                    if (s := best[i] + low) > top:
                        top, link = s, (i, -1)
                best.append(top)
                back.append(link)
                open_.append(paths)
            at, parts = len(word), []
            while at:
                start, piece = back[at]
                if piece < 0:
                    parts.append(self.spelled(word[start:at]))
                else:
                    got = ids_of.get(piece)
                    if got is None:
                        got = ids_of[piece] = piece.to_bytes(4, "little")
                    parts.append(got)
                at = start
            parts.reverse()
            out[word] = b"".join(parts)
            previous = word
        return out


def _segmenter(vocabulary: Vocabulary) -> Segmenter:
    return X.held(("pieces", hash(vocabulary)), lambda: Segmenter(vocabulary))


def encode_texts(texts: list[str | None], segmenter: Segmenter) -> list[bytes]:
    """Ids of each text as int32 bytes; a null or empty text has none.

    Texts are cut into words twice, so that only the distinct ones are held.
    """
    distinct: set[str] = set()
    for t in texts:
        if t:
            distinct.update(_UNIT.findall(" " + t))
    get = segmenter.encode_sorted(sorted(distinct)).__getitem__
    return [b"".join(map(get, _UNIT.findall(" " + t))) if t else b"" for t in texts]


def _spelling(v: Vocabulary) -> list[bytes]:
    out = [b""] * v.size
    for text, i, _ in v.pieces:
        out[i] = text.encode()
    for b, i in enumerate(v.bytes_):
        out[i] = bytes([b])
    return out


def _decoded(ids: np.ndarray, spelling: list[bytes]) -> str:
    t = b"".join(map(spelling.__getitem__, ids.tolist()))
    return (t[1:] if t[:1] == b" " else t).decode("utf-8", "replace")


def _encoder(vocabulary, column: str, back: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    segmenter = _segmenter(vocabulary.value)
    spelling = _spelling(vocabulary.value) if back else []
    for batch in batches:
        for part, _, _ in X.blocks(batch, column, 4 << 20):
            ids = encode_texts(part.column(column).to_pylist(), segmenter)
            off = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])])
            made = [X.list_array(np.frombuffer(b"".join(ids), np.int32), off)]
            if back:
                made.append(pa.array([_decoded(np.frombuffer(x, np.int32), spelling) for x in ids], pa.string()))
            yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*part.schema.names, "__ids", "__text"][: len(part.columns) + len(made)])


def _decoder(vocabulary, column: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    spelling = _spelling(vocabulary.value)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            lists = part.column(column)
            off = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False)
            texts = [_decoded(flat[a:b], spelling) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "__text"])


_IDS = ArrayType(IntegerType())


def encode(df: DataFrame, vocabulary: Vocabulary, *, text_col: str = "text", name: str = "ids", decoded: str | None = None) -> DataFrame:
    """Add ``name``, the piece ids of ``text_col``, to all columns of ``df``; and ``decoded``, what they decode to, if named.

    A blank is put before a text that isn't empty, blanks are marks, all other characters stand for themselves; characters
    without a piece, the mark itself among them, are spelled in byte pieces.  Null and empty texts have no ids.  Texts are
    encoded in blocks of four megabytes or one text; a word of any length takes memory in proportion to its length.
    """
    at = df.columns.index(text_col)
    b = df.sparkSession.sparkContext.broadcast(vocabulary)
    made = {"__ids": (name, _IDS)} | ({"__text": (decoded, StringType())} if decoded else {})
    return with_kernel(df, partial(_encoder, b, f"c{at}", bool(decoded)), made)


def decode(df: DataFrame, vocabulary: Vocabulary, *, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """Add ``name``, the text that ``ids_col`` stands for.  No ids and null ids give an empty text; control ids give nothing."""
    filled = df.withColumn(ids_col, F.coalesce(F.col(ids_col), F.array().cast(_IDS)))
    b = df.sparkSession.sparkContext.broadcast(vocabulary)
    return with_kernel(filled, partial(_decoder, b, f"c{df.columns.index(ids_col)}"), {"__text": (name, StringType())})
