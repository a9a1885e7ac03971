"""Operator 11: SentencePiece encoding and decoding that keeps the offsets of the source.

A text is normalised by the longest prefixes of the model's compiled character
map, and each normalised character keeps the byte of the source where its
prefix begins.  Characters that no piece holds side by side can never merge
over their border, so the text falls apart there into short runs; each new run
is merged once, best score first and leftmost of equals, and kept by its text.
The pieces' ends, looked up in the alignment, are the byte spans of the source.

Edges: a null text counts as empty, an empty one has no ids.  Repeated rows
give repeated rows, an empty table an empty one.  Very long texts are read in
slices, cut where neither the map nor a merge can reach over, so memory
follows the slice.  Ties of scores go to the left, as in the library.  Extra
columns are untouched by ``encode``; its result replaces a column of the same
name.  Models that aren't BPE, or have user-defined or unused pieces or a
suffix for white space, are refused with an error.
"""

from __future__ import annotations

import hashlib
import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import Strings
from .bpe import _lists as lists

#: What a space is written as in pieces.
SPACE = "▁"
#: Code points of a long text that are worked on at a time.
SLICE = 1 << 19
#: Runs kept by a worker with their pieces, and the longest run that is kept.
KEPT_RUNS, KEPT_LENGTH = 300_000, 48
#: Slots of the table of adjacent characters; two pairs in a slot only make a run longer.
PAIR_SLOTS = 1 << 22


class CharacterMap:
    """The compiled map: a double array over UTF-8 bytes whose leaves point at NUL-ended replacements."""

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little") if compiled else 0
        self.units = np.frombuffer(compiled[4 : 4 + size], dtype="<u4").tolist()
        self.texts = compiled[4 + size :]
        self._passive: dict[str, bool] = {}

    def longest(self, source: bytes, start: int) -> tuple[int, str] | None:
        """(bytes, replacement) of the longest prefix in the map of ``source`` from ``start`` on."""
        found, at = None, self._down(0, self.units[0])
        for place in range(start, len(source)):
            byte = source[place]
            at ^= byte
            unit = self.units[at] if at < len(self.units) else 0x80000000
            if unit & 0x800000FF != byte:
                break
            at = self._down(at, unit)
            if unit & 0x100:
                found = place + 1 - start, self.units[at] & 0x7FFFFFFF
        if found is None:
            return None
        n, place = found
        return n, self.texts[place : self.texts.index(b"\0", place)].decode()

    @staticmethod
    def _down(at: int, unit: int) -> int:
        return at ^ (unit >> 10 << ((unit & 0x200) >> 6))

    def passive(self, char: str) -> bool:
        """Whether no prefix in the map begins with the character."""
        if not self.units:
            return True
        if char not in self._passive:
            at, alive = self._down(0, self.units[0]), True
            for byte in char.encode():
                at ^= byte
                unit = self.units[at] if at < len(self.units) else 0x80000000
                if unit & 0x800000FF != byte:
                    alive = False
                    break
                at = self._down(at, unit)
            self._passive[char] = not alive
        return self._passive[char]


@dataclass
class Normalised:
    """Code points of a normalised slice and the source's byte where each one's prefix begins, with the end's."""

    points: np.ndarray
    starts: np.ndarray


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def _widths(points: np.ndarray) -> np.ndarray:
    """UTF-8 bytes of each code point."""
    return 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)


class Codec:
    """One model's normaliser, merges and ids."""

    def __init__(self, content: bytes):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(content)
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        if model.trainer_spec.model_type != sentencepiece_model_pb2.TrainerSpec.BPE:
            raise ValueError("only BPE models are supported")
        if model.trainer_spec.treat_whitespace_as_suffix or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError("models with user-defined or unused pieces or a white-space suffix aren't supported")
        spec = model.normalizer_spec
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.space = ord(SPACE if self.escape else " ")
        self.pieces = [p.piece for p in model.pieces]
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self.ids = normal
        order = {s: k for k, s in enumerate(sorted({model.pieces[i].score for i in normal.values()}, reverse=True))}
        self.rank = {p: order[model.pieces[i].score] for p, i in normal.items() if len(p) > 1}
        self.byte_ids = np.full(256, -1, dtype=np.int64)
        for i, p in enumerate(model.pieces):
            if p.type == kinds.BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = i
        self.fallback = model.trainer_spec.byte_fallback and bool((self.byte_ids >= 0).all())
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN)
        self.is_byte = np.zeros(len(self.pieces), dtype=bool)
        self.is_byte[self.byte_ids[self.byte_ids >= 0]] = True
        silent = {i for i, p in enumerate(model.pieces) if p.type == kinds.CONTROL}
        self.silent = np.isin(np.arange(len(self.pieces)), list(silent))
        value = {int(i): bytes([b]) for b, i in enumerate(self.byte_ids) if i >= 0} | {self.unknown: model.trainer_spec.unk_surface.encode()}
        self.surfaces = Strings([b"" if i in silent else value.get(i, p.replace(SPACE, " ").encode()) for i, p in enumerate(self.pieces)])
        self.decimals = Strings([f"{i},".encode() for i in range(len(self.pieces))])
        self.begins_with_space = np.zeros(len(self.pieces), dtype=bool)
        self.begins_with_space[[i for p, i in normal.items() if p.startswith(SPACE)]] = True
        self.together = np.zeros(PAIR_SLOTS, dtype=bool)
        for p in self.rank:
            points = _points(p)
            self.together[self._slots(points[:-1], points[1:])] = True
        self.runs: dict[str, tuple[list[int], list[int]]] = {}

    @staticmethod
    def _slots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return ((a * np.uint32(0x9E3779B1)) ^ (b * np.uint32(0x85EBCA6B))) >> np.uint32(10)

    # Normalisation

    def slices(self, text: str):
        """Parts of a text between which neither the map, nor squeezed spaces, nor a merge reaches over."""
        start = 0
        while len(text) - start > SLICE:
            end = start + SLICE
            while end < len(text) and not self._cut(text[end - 1], text[end]):
                end += 1
            yield text[start:end]
            start = end
        yield text[start:]

    def _cut(self, a: str, b: str) -> bool:
        if not (self.map.passive(a) and self.map.passive(b)) or (self.squeeze and " " in (a, b)):
            return False
        x, y = ((self.space if c == " " else ord(c)) for c in (a, b))
        return not self.together[self._slots(np.array([x], dtype=np.uint32), np.array([y], dtype=np.uint32))[0]]

    def normalised(self, text: str, first: bool = True, last: bool = True, offset: int = 0) -> Normalised:
        """A text's slice in the model's normal form; ``offset`` is the slice's first byte in the source."""
        points = _points(text)
        widths = _widths(points)
        starts = offset + np.cumsum(widths) - widths
        end = offset + int(widths.sum())
        lead = offset
        if self.map.units:
            points, starts, lead = self._mapped(text, points, starts, end)
        elif self.squeeze:
            solid = np.flatnonzero(points != 32)
            lead = int(starts[solid[0]]) if len(solid) else end
        if not len(text) or (self.squeeze and first and lead == end):
            return Normalised(np.zeros(0, dtype=np.uint32), np.array([end]))
        if self.squeeze:
            spaces = points == 32
            before = np.concatenate([[first], spaces[:-1]]) if len(spaces) else spaces
            points, starts = points[~(spaces & before)], starts[~(spaces & before)]
        if self.escape:
            points = np.where(points == 32, np.uint32(self.space), points)
        if first and self.prefix:
            points = np.concatenate([np.array([self.space], dtype=np.uint32), points])
            starts = np.concatenate([[lead if self.squeeze else offset], starts])
        if self.squeeze and last:
            while len(points) and points[-1] == self.space:
                points, starts, end = points[:-1], starts[:-1], int(starts[-1])
        return Normalised(points, np.concatenate([starts, [end]]))

    def _mapped(self, text: str, points: np.ndarray, starts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Longest prefixes replaced; also where the first prefix begins that isn't a space."""
        distinct = np.unique(points)
        active = distinct[[not self.map.passive(chr(c)) for c in distinct.tolist()]]
        source, first = text.encode(), int(starts[0]) if len(starts) else 0
        at, parts, lead = 0, [], None
        for i in np.flatnonzero(np.isin(points, active)).tolist():
            if i < at:
                continue
            begin = int(starts[i])
            found = self.map.longest(source, begin - first)
            if found is None:
                continue
            if i > at:
                parts.append((points[at:i], starts[at:i]))
            n, new = found
            new_points = _points(new)
            parts.append((new_points, np.full(len(new_points), begin)))
            if lead is None and new != " " and not any((p != 32).any() for p, _ in parts[:-1]):
                lead = begin
            at = int(np.searchsorted(starts, begin + n))
        parts.append((points[at:], starts[at:]))
        points, starts = (np.concatenate(x) for x in zip(*parts))
        solid = np.flatnonzero(points != 32)
        plain = int(starts[solid[0]]) if len(solid) else end
        return points.astype(np.uint32), starts, plain if lead is None else min(lead, plain)

    # Merging

    def merged(self, run: str) -> list[str]:
        """The run's characters after all merges, the best score first, the leftmost of equals."""
        if len(run) > KEPT_LENGTH:
            return self._merged_by_heap(run)
        parts, get, none = list(run), self.rank.get, len(self.pieces)
        ranks = [get(pair, none) for pair in map(str.__add__, parts, parts[1:])]
        while ranks and (low := min(ranks)) < none:
            i = ranks.index(low)
            new = parts[i] = parts[i] + parts.pop(i + 1)
            del ranks[i]
            if i < len(ranks):
                ranks[i] = get(new + parts[i + 1], none)
            if i:
                ranks[i - 1] = get(parts[i - 1] + new, none)
        return parts

    def _merged_by_heap(self, run: str) -> list[str]:
        parts, rank = list(run), self.rank
        right = [*range(1, len(parts)), -1]
        left = list(range(-1, len(parts) - 1))
        heap = [(rank[a + b], i, a + b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in rank]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = right[i]
            if not parts[i] or j < 0 or parts[i] + parts[j] != pair:
                continue
            parts[i], parts[j], right[i] = pair, "", right[j]
            if right[i] >= 0:
                left[right[i]] = i
                if (new := pair + parts[right[i]]) in rank:
                    heapq.heappush(heap, (rank[new], i, new))
            if left[i] >= 0 and (new := parts[left[i]] + pair) in rank:
                heapq.heappush(heap, (rank[new], left[i], new))
        return [p for p in parts if p]

    def _ids_of(self, run: str) -> tuple[list[int], list[int]]:
        """Ids of a run and each id's code points; of the bytes of an unknown character all but the last have none."""
        ids, lengths = [], []
        for part in self.merged(run):
            known = self.ids.get(part)
            if known is not None:
                ids.append(known)
                lengths.append(len(part))
            elif self.fallback:
                data = part.encode()
                ids += self.byte_ids[list(data)].tolist()
                lengths += [0] * (len(data) - 1) + [len(part)]
            elif ids and ids[-1] == self.unknown:
                lengths[-1] += len(part)  # unknown neighbours are one unknown piece
            else:
                ids.append(self.unknown)
                lengths.append(len(part))
        return ids, lengths

    def encode_slice(self, norm: Normalised) -> tuple[np.ndarray, np.ndarray]:
        """(ids, code points of each) of a normalised slice."""
        points = norm.points
        if not len(points):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        text = points.astype("<u4").tobytes().decode("utf-32-le")
        apart = ~self.together[self._slots(points[:-1], points[1:])]
        bounds = [0, *(np.flatnonzero(apart) + 1).tolist(), len(points)]
        if len(self.runs) > KEPT_RUNS:
            self.runs.clear()
        ids, lengths, get = [], [], self.runs.get
        for a, b in zip(bounds, bounds[1:]):
            run = text[a:b]
            found = get(run)
            if found is None:
                found = self._ids_of(run)
                if len(run) <= KEPT_LENGTH:
                    self.runs[run] = found
            ids += found[0]
            lengths += found[1]
        ids, lengths = np.array(ids, dtype=np.int64), np.array(lengths, dtype=np.int64)
        if not self.fallback:
            ids, lengths = self._joined_unknown(ids, lengths)
        return ids, lengths

    def _joined_unknown(self, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unknown pieces side by side become one, over the runs' borders too."""
        again = np.concatenate([[False], (ids[1:] == self.unknown) & (ids[:-1] == self.unknown)])
        return ids[~again], np.add.reduceat(lengths, np.flatnonzero(~again)) if len(lengths) else lengths

    def encode_parts(self, text: str):
        """(ids, first byte, byte after the last) of a text, slice by slice."""
        if not text:
            return
        parts, offset, first = list(self.slices(text)), 0, True
        for k, part in enumerate(parts):
            norm = self.normalised(part, first, k == len(parts) - 1, offset)
            ids, lengths = self.encode_slice(norm)
            ends = np.cumsum(lengths)
            stop = norm.starts[ends]
            begin = norm.starts[ends - lengths]
            inner = np.flatnonzero(lengths == 0)  # bytes before the last of an unknown character
            stop[inner] = begin[inner]
            yield ids, begin, stop
            offset += len(part.encode())
            first = False

    # Decoding

    def decode(self, ids: np.ndarray, first: bool = True) -> bytes:
        """The text's UTF-8 bytes; invalid runs of byte pieces become U+FFFD, byte by byte."""
        if not len(ids):
            return b""
        data = self.surfaces.joined(ids).tobytes()
        try:
            data.decode()
            whole = not self.silent[ids].any()  # else bytes on its two sides may seem to be one character
        except UnicodeDecodeError:
            whole = False
        if not whole:
            data = self._with_bytes(ids)
        if first and (self.prefix or self.squeeze):
            data = self._without_prefix(ids, data)
        return data

    def _without_prefix(self, ids: np.ndarray, data: bytes) -> bytes:
        """Without the first space of the first piece that has text."""
        for i in ids.tolist():
            if self.begins_with_space[i]:
                return data[1:]
            if self.surfaces.lengths[i]:
                return data
        return data

    def _with_bytes(self, ids: np.ndarray) -> bytes:
        flags = self.is_byte[ids]
        cuts = [0, *(np.flatnonzero(flags[1:] != flags[:-1]) + 1).tolist(), len(ids)]
        out = []
        for a, b in zip(cuts, cuts[1:]):
            part = self.surfaces.joined(ids[a:b]).tobytes()
            out.append(_valid(part) if flags[a] else part)
        return b"".join(out)

    def digest(self, text: str) -> tuple[int, str, str]:
        """(number of ids, sha256 of their decimals, sha256 of the text that they decode to)."""
        n, of_ids, of_text, first = 0, hashlib.sha256(), hashlib.sha256(), True
        for ids, _, _ in self.encode_parts(text):
            if not len(ids):
                continue
            of_ids.update(b"" if first else b",")
            of_ids.update(self.decimals.joined(ids)[:-1].data)
            of_text.update(self.decode(ids, first))
            n += len(ids)
            first = False
        return n, of_ids.hexdigest(), of_text.hexdigest()


def _valid(data: bytes) -> bytes:
    """The bytes with each one that isn't part of valid UTF-8 replaced by U+FFFD."""
    out = []
    while data:
        try:
            data.decode()
            out.append(data)
            break
        except UnicodeDecodeError as e:
            out += [data[: e.start], "�".encode()]
            data = data[e.start + 1 :]
    return b"".join(out)


_codecs: dict[int, Codec] = {}


def codec(content: bytes) -> Codec:
    """The codec of a model's content, one for each Python worker."""
    key = hash(content)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(content)
    return _codecs[key]


def _model(spark: SparkSession, model_path: str | None):
    """The model file's bytes for the executors; its size is that of the file, checked here."""
    if model_path is None:
        import public_tokenizers

        model_path = public_tokenizers.path("piece_bpe_32k.model")
    with open(model_path, "rb") as f:
        content = f.read()
    if len(content) > 64 << 20:
        raise ValueError("a model of over 64 MB isn't broadcast")
    return spark.sparkContext.broadcast(content)


ENCODED = "struct<ids:array<int>,begins:array<int>,ends:array<int>>"


def encoder(spark: SparkSession, model_path: str | None = None):
    """A column function: text to struct(ids, begins, ends); the spans are bytes of the source text's UTF-8."""
    shared = _model(spark, model_path)

    @F.arrow_udf(ENCODED)
    def encode(texts: pa.Array) -> pa.Array:
        coder, counts, columns = codec(shared.value), [], ([], [], [])
        for t in texts:
            n = 0
            for part in coder.encode_parts(t.as_py() or ""):
                n += len(part[0])
                for column, values in zip(columns, part):
                    column.append(values.astype(np.int32))
            counts.append(np.array([n]))
        return pa.StructArray.from_arrays([lists(c, counts) for c in columns], names=["ids", "begins", "ends"])

    return encode


def decoder(spark: SparkSession, model_path: str | None = None):
    """A column function: array of ids to text; null ids give null."""
    shared = _model(spark, model_path)

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        coder = codec(shared.value)
        return pa.array([None if x is None else coder.decode(np.array(x, dtype=np.int64)).decode() for x in (v.as_py() for v in ids)], pa.string())

    return decode


def digester(spark: SparkSession, model_path: str | None = None):
    """A column function: text to struct(n_tokens, ids_sha256, decoded_sha256); ids stay in the worker, slice by slice."""
    shared = _model(spark, model_path)

    @F.arrow_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    def digest(texts: pa.Array) -> pa.Array:
        coder = codec(shared.value)
        rows = [coder.digest(t.as_py() or "") for t in texts]
        columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.string(), pa.string()))]
        return pa.StructArray.from_arrays(columns, names=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digest


def encode(df: DataFrame, text: str | Column = "text", out: str = "encoded", model_path: str | None = None) -> DataFrame:
    """``df`` with a column ``out``: struct(ids, begins, ends) of the whole text."""
    column = F.col(text) if isinstance(text, str) else text
    return df.withColumn(out, encoder(df.sparkSession, model_path)(F.coalesce(column, F.lit(""))))


def op11_sentencepiece(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """Digest of each document's ids and of the text that they decode to."""
    found = digester(docs.sparkSession, model_path)(F.coalesce("text", F.lit("")))
    return docs.select("doc_id", found.alias("d")).select("doc_id", "d.*")
