"""SentencePiece encoding that keeps the source bytes of every piece."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as model_files

from .common import small_batches

SPACE = "▁"
SPACE_BYTES = SPACE.encode()


class CharacterMap:
    """A compiled character map: a double-array trie of byte strings, and what replaces them.

    The map is the size of the trie in bytes, its 32-bit units, then replacements that
    end in a zero byte. A unit holds its label in the low byte, the offset of its
    children from bit 10 on (in steps of 256 if bit 9 is set), and in bit 8 whether a
    string ends; the value of a leaf is the place of the replacement.
    """

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little")
        self.units = np.frombuffer(compiled[4 : 4 + size], "<u4").tolist()
        self.texts = compiled[4 + size :]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest mapped string that stands at ``at``."""
        units, found = self.units, None
        node = self._offset(units[0])
        for k in range(at, len(data)):
            node ^= data[k]
            if node >= len(units) or units[node] & 0x800000FF != data[k]:
                break
            unit = units[node]
            node ^= self._offset(unit)
            if unit & 0x100:
                found = (k + 1 - at, units[node] & 0x7FFFFFFF)
        return found and (found[0], self.texts[found[1] : self.texts.index(b"\0", found[1])])


class Normalizer:
    """Text to normalised bytes, and for each of them where its source character or mapped string begins."""

    def __init__(self, spec):
        self.map = CharacterMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self.prefix, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.space = SPACE_BYTES if self.escape else b" "

    def normalise(self, text: str) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and one source offset for each of them and for the end."""
        data = text.encode("utf-8", "surrogatepass")
        if not data:
            return b"", np.zeros(1, np.int32)
        if self.map is None and not self.squeeze:
            return self._kept(data)
        return self._mapped(data)

    def _kept(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """Nothing is replaced but blanks by their mark."""
        head, codes = self.space if self.prefix else b"", np.frombuffer(data, np.uint8)
        begins = np.maximum.accumulate(np.where(codes & 0xC0 != 0x80, np.arange(len(data), dtype=np.int32), 0))
        sources = np.repeat(begins, np.where(codes == 32, len(self.space), 1)).astype(np.int32)
        return head + data.replace(b" ", self.space), np.concatenate((np.zeros(len(head), np.int32), sources, np.array([len(data)], np.int32)))

    def _steps(self, data: bytes) -> Iterator[tuple[int, int, bytes]]:
        """Start, end and replacement of each longest mapped string; other characters stand for themselves."""
        at = 0
        while at < len(data):
            found = self.map.longest(data, at) if self.map else None
            if found is None:
                lead = data[at]
                length = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                found = (length, data[at : at + length])
            yield at, at + found[0], found[1]
            at += found[0]

    def _mapped(self, data: bytes) -> tuple[bytes, np.ndarray]:
        out, sources, blank, end = bytearray(), [], self.squeeze, 0
        for start, stop, new in self._steps(data):
            if blank:
                new = new.lstrip(b" ")
            if self.squeeze and not out and new and self.prefix or not self.squeeze and self.prefix and not out and start == 0:
                # The mark before the first character that stays.
                out += self.space
                sources += [start] * len(self.space)
            for byte in new:
                piece = self.space if byte == 32 else bytes((byte,))
                out += piece
                sources += [start] * len(piece)
            if new:
                blank = self.squeeze and new.endswith(b" ")
            end = stop
        while self.squeeze and out.endswith(self.space):
            # Blanks at the end go, and with them their source.
            end = sources[len(out) - len(self.space)]
            del out[-len(self.space) :], sources[-len(self.space) :]
        return bytes(out), np.array([*sources, end if out else 0], np.int32)


class Pieces:
    """A model with byte fallback, split into its normaliser and what makes pieces of normalised text."""

    def __init__(self, file: bytes):
        proto = model_files.ModelProto.FromString(file)
        kinds = model_files.ModelProto.SentencePiece
        if not proto.trainer_spec.byte_fallback or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models with byte fallback and marks before words are supported")
        if any(p.type == kinds.USER_DEFINED for p in proto.pieces):
            raise ValueError("models with user-defined pieces are not supported")
        self.normalizer = Normalizer(proto.normalizer_spec)
        #: Normalised bytes of each piece; a byte piece is one byte of a character.
        self.sizes = np.array([1 if p.type == kinds.BYTE else len(p.piece.encode()) for p in proto.pieces], np.int64)
        self.decode = sentencepiece.SentencePieceProcessor(model_proto=file).decode
        # The text comes normalised, so the library only makes pieces of it.
        proto.normalizer_spec.CopyFrom(model_files.NormalizerSpec(add_dummy_prefix=False, remove_extra_whitespaces=False, escape_whitespaces=False))
        self.split = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString()).encode

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per text the ids of its pieces, and where each begins and ends in its bytes.

        A piece covers the sources of its normalised bytes. All bytes of an unknown
        character begin where it does, and the last one spans it.
        """
        normalised = [self.normalizer.normalise(text) for text in texts]
        out = []
        for found, (_, sources) in zip(self.split([data.decode() for data, _ in normalised], num_threads=1), normalised, strict=True):
            ids = np.array(found, np.int32)
            ends = np.cumsum(self.sizes[ids])
            out.append((ids, sources[ends - self.sizes[ids]], sources[ends]))
        return out


def listed(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.array([0, *accumulate(map(len, parts))], np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts) if parts else np.empty(0, np.int32)))


def encode_pieces(docs: DataFrame, model_path: str) -> DataFrame:
    """Every text as ids of a sentencepiece model, with their source bytes, and decoded again.

    Returns doc_id, ids, starts, ends, decoded: per row of ``docs`` the ids that the
    model's own library gives (without begin and end ids), for each the bytes of the
    text that it stands for, and the text that the library's decode makes of the ids.
    Normalisation walks the model's compiled character map by longest prefixes and keeps
    the source of every byte; the library makes pieces of the normalised text, and each
    piece is projected on its sources. A null text counts as empty and has no ids. Ids of
    documents may be null or repeat; other columns are not read. Whole texts are encoded.
    ``model_path`` is a file of the driver, whose bytes (some 500 KB) travel with the
    tasks. The pass is narrow.
    """
    with open(model_path, "rb") as file:
        model = file.read()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model)
        for batch in batches:
            found = pieces.encode([text or "" for text in batch.column(1).to_pylist()])
            ids, starts, ends = ([f[k] for f in found] for k in range(3))
            decoded = pieces.decode([i.tolist() for i in ids], num_threads=1) if ids else []
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), listed(ids), listed(starts), listed(ends), pa.array(decoded, pa.string())],
                ["doc_id", "ids", "starts", "ends", "decoded"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return small_batches(docs.select("doc_id", "text")).mapInArrow(
        encode, f"doc_id {kind}, ids array<int>, starts array<int>, ends array<int>, decoded string"
    )
