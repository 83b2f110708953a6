"""Encoding texts with a SentencePiece BPE model, and decoding ids, with every piece's source bytes.

A text is normalised by the model's compiled character map: at each position the longest rule that
begins there replaces what it matches, anything else is taken as it is. Beside the normalised text
runs an alignment that holds, for each of its bytes, the byte of the source it came from. Symbols
are merged best score first, leftmost on ties; what is in no piece falls back to bytes. Each piece's
place in the normalised text then gives its span of source bytes through the alignment.

No piece of the vocabulary joins certain neighbours (in the usual model: a word and the white space
after it, or anything and a character that is in no longer piece), so a text is cut there, and the
pieces of short stretches are remembered by each Python worker; new ones are merged together.

The model file is read on the driver and sent to the tasks; it may have `MAX_MODEL_BYTES`.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as proto

from martloom.llm.tables import text_ranges

SPACE = "▁"
MAX_MODEL_BYTES = 64 << 20
# Stretches of at most so many characters are merged together, so many at a time, and remembered by
# a Python worker, about so many of them.
FEW = 48
TOGETHER = 1 << 14
REMEMBERED = 1 << 17


class CharacterMap:
    """The rules of a compiled character map: a double-array trie over UTF-8 bytes, whose values are
    places in a block of replacements, each ended by a zero byte."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], dtype="<u4").tolist()
        self.replacements = blob[4 + size :]
        self.starts = self._first_bytes()

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & (1 << 9)) >> 6)

    def _first_bytes(self) -> re.Pattern | None:
        if not self.units:
            return None
        root = self._offset(self.units[0])
        found = [b for b in range(1, 256) if self._child(root, b) is not None]
        return re.compile(b"[" + re.escape(bytes(found)) + b"]") if found else None

    def _child(self, node: int, byte: int) -> int | None:
        at = node ^ byte
        if at >= len(self.units) or self.units[at] & ((1 << 31) | 0xFF) != byte:
            return None
        return at

    def longest(self, data: bytes, start: int) -> tuple[int, bytes]:
        """Length and replacement of the longest rule that begins at `start`; length 0 for none."""
        length, value = 0, 0
        node = self._offset(self.units[0])
        for at in range(start, len(data)):
            found = self._child(node, data[at])
            if found is None:
                break
            unit = self.units[found]
            node = found ^ self._offset(unit)
            if unit >> 8 & 1:
                length, value = at + 1 - start, self.units[node] & ((1 << 31) - 1)
        if not length:
            return 0, b""
        return length, self.replacements[value : self.replacements.index(b"\0", value)]


class Merges:
    """Which neighbouring symbols make a piece, and how early they are merged.

    A symbol is a piece's id, or `size` + code point for a character that is no piece.
    """

    def __init__(self, ids: dict[str, int], ranks: dict[str, int], size: int):
        self.size, self.ids, self.ranks = size, ids, ranks
        found = {}
        for piece, number in ids.items():
            for at in range(1, len(piece)):
                left, right = self._symbol(piece[:at]), self._symbol(piece[at:])
                if left is not None and right is not None:
                    found[left << 32 | right] = ranks[piece], number
        self.pairs = np.array(sorted(found), dtype=np.int64)
        self.rank, self.merged = np.array([found[k] for k in self.pairs.tolist()] or [(0, 0)]).T
        self.single = np.arange(0x110000, dtype=np.int64) + size
        for piece, number in ids.items():
            if len(piece) == 1:
                self.single[ord(piece)] = number

    def _symbol(self, text: str) -> int | None:
        return self.ids.get(text, self.size + ord(text) if len(text) == 1 else None)

    def _places(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place of each pair in `pairs`, -1 for none."""
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where(self.pairs[at] == wanted, at, -1) if len(self.pairs) else at - 1

    def merge_all(self, stretches: list[str]) -> list[list[int]]:
        """The symbols of each stretch. In each round every stretch merges its best pair, the
        leftmost of equals; those without one are done."""
        symbols = self.single[np.frombuffer("".join(stretches).encode("utf-32-le"), dtype=np.uint32)]
        sizes = np.array([len(s) for s in stretches])
        done = []
        names = np.arange(len(stretches))
        ends = np.cumsum(sizes)
        place = np.full(len(symbols), -1)  # of the pair of a symbol and the next
        place[:-1] = self._places(symbols[:-1], symbols[1:])
        place[ends - 1] = -1
        never = np.int64(1) << 62
        while len(names):
            starts = ends - sizes
            order = np.where(place >= 0, self.rank[place] << 32 | np.arange(len(place)), never)
            best = np.minimum.reduceat(order, starts)
            live = best < never
            if not live.all():
                stay = np.repeat(live, sizes)
                done.append((names[~live], sizes[~live], symbols[~stay]))
                back = np.cumsum(stay) - 1
                best = best[live]
                at = back[best & 0xFFFFFFFF]
                symbols, place, names, sizes = symbols[stay], place[stay], names[live], sizes[live]
                ends = np.cumsum(sizes)
            else:
                at = best & 0xFFFFFFFF
            symbols[at] = self.merged[place[at]]
            stay = np.ones(len(symbols), dtype=bool)
            stay[at + 1] = False
            symbols, place = symbols[stay], place[stay]
            at -= np.arange(len(at))
            sizes = sizes - 1
            ends = np.cumsum(sizes)
            for left in (at, at - 1):  # the pairs on both sides of the merged symbol
                inside = (left >= ends - sizes) & (left < ends - 1)
                place[left[left >= ends - sizes]] = -1
                left = left[inside]
                place[left] = self._places(symbols[left], symbols[left + 1])
        names, sizes, symbols = (np.concatenate(part) for part in zip(*done))
        edges, symbols = np.concatenate([[0], np.cumsum(sizes)]).tolist(), symbols.tolist()
        out: list[list[int]] = [[]] * len(stretches)
        for name, start, stop in zip(names.tolist(), edges, edges[1:]):
            out[name] = symbols[start:stop]
        return out

    def merge_long(self, stretch: str) -> list[int]:
        """The same for one long stretch, with a queue of pairs."""
        symbols: list[str] = list(stretch)
        before, after = list(range(-1, len(symbols) - 1)), list(range(1, len(symbols) + 1))
        queue = []

        def offer(left: int, right: int) -> None:
            joined = symbols[left] + symbols[right]
            rank = self.ranks.get(joined)
            if rank is not None:
                heapq.heappush(queue, (rank, left, right, len(joined)))

        for left, right in pairwise(range(len(symbols))):
            offer(left, right)
        while queue:
            _, left, right, size = heapq.heappop(queue)
            # the pair may have been merged with others meanwhile
            if not (symbols[left] and symbols[right]):
                continue
            if len(symbols[left]) + len(symbols[right]) != size:
                continue
            symbols[left] += symbols[right]
            symbols[right] = ""
            following = after[left] = after[right]
            if following < len(symbols):
                before[following] = left
                offer(left, following)
            if before[left] >= 0:
                offer(before[left], left)
        return [self._symbol(s) for s in symbols if s]


@dataclass
class PieceModel:
    """A BPE model with byte fallback; `from_bytes` reads a model file's content."""

    pieces: list[str]
    merges: Merges
    byte_ids: list[int]
    kinds: list[int]
    unknown: int
    end: int
    unknown_surface: str
    charmap: CharacterMap
    dummy_prefix: bool
    trimmed: bool
    escaped: bool
    stretch: re.Pattern

    @classmethod
    def from_bytes(cls, content: bytes) -> PieceModel:
        model = proto.ModelProto.FromString(content)
        kind, trainer, rules = proto.ModelProto.SentencePiece, model.trainer_spec, model.normalizer_spec
        kinds = [p.type for p in model.pieces]
        if trainer.model_type != trainer.BPE or not trainer.byte_fallback:
            raise ValueError("only BPE models with byte fallback can be read")
        if {kind.USER_DEFINED, kind.UNUSED} & set(kinds) or trainer.treat_whitespace_as_suffix:
            raise ValueError("models with own symbols, unused pieces or space suffixes can't be read")
        if model.denormalizer_spec.precompiled_charsmap:
            raise ValueError("models with a map for decoding can't be read")
        pieces = [p.piece for p in model.pieces]
        ids = {p: i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == kind.NORMAL}
        places = {p: i for i, p in enumerate(pieces)}
        scores = sorted({model.pieces[i].score for i in ids.values()}, reverse=True)
        order = {score: rank for rank, score in enumerate(scores)}
        ranks = {p: order[model.pieces[i].score] for p, i in ids.items()}
        return cls(
            pieces, Merges(ids, ranks, len(pieces)),
            [places[f"<0x{b:02X}>"] for b in range(256)], kinds,
            kinds.index(kind.UNKNOWN), trainer.eos_id, trainer.unk_surface,
            CharacterMap(rules.precompiled_charsmap), rules.add_dummy_prefix,
            rules.remove_extra_whitespaces, rules.escape_whitespaces, _stretches(list(ids)),
        )

    @classmethod
    def load(cls, path: str) -> PieceModel:
        with open(path, "rb") as file:
            content = file.read(MAX_MODEL_BYTES + 1)
        if len(content) > MAX_MODEL_BYTES:
            raise ValueError(f"{path} has more than {MAX_MODEL_BYTES} bytes")
        return cls.from_bytes(content)

    def __post_init__(self):
        self.newer: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}
        self.sizes = np.array(
            [1 if k == proto.ModelProto.SentencePiece.BYTE else len(p.encode())
             for p, k in zip(self.pieces, self.kinds)]
        )

    def __getstate__(self):
        return {**self.__dict__, "newer": {}, "older": {}}

    # normalisation

    def normalised(self, text: str) -> tuple[str, np.ndarray]:
        """The text that is cut into pieces, and for each of its bytes, and its end, the byte of the
        source it came from."""
        source = text.encode()
        if not source:
            return "", np.zeros(0, dtype=np.int64)
        data, origin, opens = self._mapped(source)
        consumed = 0
        if self.trimmed:
            space = data == 32
            # a unit of the map loses its leading spaces after a space and at the start
            unit = np.maximum.accumulate(np.where(opens, np.arange(len(data)), 0))
            letters = np.concatenate([[0], np.cumsum(~space)])
            leading = letters[1:] == letters[unit]
            after = np.where(unit > 0, space[np.maximum(unit - 1, 0)], True)
            keep = ~(leading & after)
            single = opens & np.concatenate([opens[1:], [True]]) & space
            heading = len(data) if single.all() else int(np.argmin(single))
            if heading == len(data):
                return "", np.zeros(0, dtype=np.int64)
            consumed = int(origin[heading])
            data, origin = data[keep], origin[keep]
        mark = SPACE if self.escaped else " "
        final = len(source)
        if self.trimmed:
            kept = len(data)
            while kept and data[kept - 1] == 32:
                kept -= 1
            if kept < len(data):
                final = int(origin[kept])
            data, origin = data[:kept], origin[:kept]
        times = np.where(data == 32, len(mark.encode()), 1)
        origin = np.repeat(origin, times)
        out = data.tobytes().decode().replace(" ", mark)
        if self.dummy_prefix:
            out = mark + out
            origin = np.concatenate([np.full(len(mark.encode()), consumed), origin])
        if self.trimmed and out == mark:  # the prefix is taken for trailing space, too
            return "", np.zeros(0, dtype=np.int64)
        return out, np.append(origin, final)

    def _mapped(self, source: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes after the character map, the source byte each came from, and whether it is the first
        byte of its rule or character."""
        raw = np.frombuffer(source, dtype=np.uint8)
        first = (raw & 0xC0) != 0x80
        origin = np.maximum.accumulate(np.where(first, np.arange(len(raw)), 0))
        if self.charmap.starts is None:
            return raw, origin, first
        parts, done, at = [], 0, 0
        while found := self.charmap.starts.search(source, at):
            at = found.start()
            length, new = self.charmap.longest(source, at) if first[at] else (0, b"")
            if not length:
                at += 1
                continue
            parts.append((raw[done:at], origin[done:at], first[done:at]))
            new = np.frombuffer(new, dtype=np.uint8)
            parts.append((new, np.full(len(new), at), np.arange(len(new)) == 0))
            done = at = at + length
        parts.append((raw[done:], origin[done:], first[done:]))
        return tuple(np.concatenate(p) for p in zip(*parts))

    # encoding

    def encode(self, texts: Sequence[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each text its ids, and the first and the end byte of each piece in the source. Of the
        bytes that stand for one character the last has its span, the others are empty at its
        start."""
        normal = [self.normalised(t) for t in texts]
        stretches = [self.stretch.findall(n) for n, _ in normal]
        known = self._known(set().union(*stretches))
        out = []
        for found, (_, origin) in zip(stretches, normal):
            ids = np.fromiter(chain.from_iterable(map(known.__getitem__, found)), dtype=np.int32)
            if not len(ids):
                out.append((ids, ids, ids))
                continue
            # all bytes of a character come from its first one, so a byte piece's edges do, too
            edges = origin[np.concatenate([[0], np.cumsum(self.sizes[ids])])]
            out.append((ids, edges[:-1], edges[1:]))
        return out

    def _known(self, wanted: set[str]) -> dict[str, list[int]]:
        """The ids of all stretches that are wanted. Short ones are remembered for a while."""
        if len(self.newer) > REMEMBERED:
            self.older, self.newer = self.newer, {}
        missing = wanted.difference(self.newer)
        again = missing.intersection(self.older)
        self.newer.update((s, self.older[s]) for s in again)
        missing -= again
        long = {s for s in missing if len(s) > FEW}
        few = list(missing - long)
        for at in range(0, len(few), TOGETHER):
            part = few[at : at + TOGETHER]
            self.newer.update(zip(part, map(self._ids, self.merges.merge_all(part))))
        if not long:
            return self.newer
        return {**self.newer, **{s: self._ids(self.merges.merge_long(s)) for s in long}}

    def _ids(self, symbols: list[int]) -> list[int]:
        if max(symbols) < len(self.pieces):
            return symbols
        out = []
        for symbol in symbols:
            if symbol < len(self.pieces):
                out.append(symbol)
            else:
                out += [self.byte_ids[b] for b in chr(symbol - len(self.pieces)).encode()]
        return out

    # decoding

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids: bytes are put together, each byte that forms no character becomes U+FFFD;
        the space put before a text is taken away."""
        surfaces = self.surfaces
        parts = [surfaces[i] for i in ids]
        first = next((n for n, p in enumerate(parts) if p), None)
        if first is not None and (self.dummy_prefix or self.trimmed):
            gone = len(parts) if self.trimmed else first + 1
            for n in range(first, gone):
                if self.kinds[ids[n]] == proto.ModelProto.SentencePiece.NORMAL:
                    parts[n] = parts[n].removeprefix(b" ")
                if parts[n]:
                    break
        if b"" not in parts[:-1]:  # an id without text ends a run of bytes
            try:
                return b"".join(parts).decode()
            except UnicodeDecodeError:
                pass
        return _with_replacements(parts, [self.kinds[i] for i in ids])

    @property
    def surfaces(self) -> list[bytes]:
        if "_surfaces" not in self.__dict__:
            kind = proto.ModelProto.SentencePiece
            made = {
                kind.NORMAL: lambda p: p.replace(SPACE, " ").encode(),
                kind.BYTE: lambda p: bytes([int(p[1:-1], 16)]),
                kind.CONTROL: lambda p: b"",
                kind.UNKNOWN: lambda p: self.unknown_surface.encode(),
            }
            self._surfaces = [made[k](p) for p, k in zip(self.pieces, self.kinds)]
        return self._surfaces


def _stretches(pieces: list[str]) -> re.Pattern:
    """Stretches of a normalised text over whose edges no piece goes.

    Characters that stand side by side in a piece belong together, and so do those of the pieces
    they share: letters of a script, say, or marks. A stretch is a run of one such class with the
    space before it, a run of spaces, or a single character that no longer piece holds.
    """
    parents: dict[str, str] = {}

    def root(c: str) -> str:
        while parents.setdefault(c, c) != c:
            c = parents[c]
        return c

    inner = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces)
    for piece in pieces:
        body = piece if inner else piece.lstrip(SPACE)
        for a, b in pairwise(body):
            parents[root(a)] = root(b)
        if len(body) == 1 and body != piece:
            root(body)
    classes: dict[str, str] = {}
    for c in sorted(parents):
        classes[root(c)] = classes.get(root(c), "") + c
    runs = "|".join(f"[{re.escape(c)}]+" for c in sorted(classes.values(), key=len, reverse=True))
    if inner:
        return re.compile(f"{runs}|.", re.DOTALL)
    return re.compile(f"{SPACE}*(?:{runs})|{SPACE}+|." if runs else f"{SPACE}+|.", re.DOTALL)


def _with_replacements(parts: list[bytes], kinds: list[int]) -> str:
    """Runs of byte pieces decoded one by one, with U+FFFD for every byte that fits no character."""
    out, run = [], b""
    for part, kind in [*zip(parts, kinds), (b"", None)]:
        if kind == proto.ModelProto.SentencePiece.BYTE:
            run += part
            continue
        while run:
            for size in (1, 2, 3, 4):
                try:
                    out.append(run[:size].decode())
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                size = 1
            run = run[size:]
        out.append(part.decode())
    return "".join(out)


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate(values).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def encoded(
    docs: DataFrame, model: PieceModel, end: bool = True, decode: bool = False
) -> DataFrame:
    """(doc_id, ids, begins, ends), one row per row of `docs(doc_id, text)`: the ids of the whole text,
    with the model's end id last if `end`, and the source bytes [begin, end) of each (the end id: none
    at the end). With `decode` also `decoded`, the text of these ids. NULL is the empty text, which has
    no pieces. Other columns are ignored; an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids array<int>, begins array<int>, ends array<int>"
    if decode:
        schema += ", decoded string"
    names = [part.split()[0] for part in schema.split(", ")]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for start, stop in text_ranges(texts):
                found = model.encode(texts[start:stop])
                if end:
                    sizes = [np.int32(len(t.encode())) for t in texts[start:stop]]
                    found = [
                        (np.append(i, np.int32(model.end)), np.append(b, n), np.append(e, n))
                        for (i, b, e), n in zip(found, sizes)
                    ]
                lists = [_lists([f[n] for f in found]) for n in range(3)]
                if decode:
                    lists.append(pa.array([model.decode(i.tolist()) for i, _, _ in found], pa.string()))
                yield pa.RecordBatch.from_arrays([batch.column(0)[start:stop], *lists], names)

    return docs.select("doc_id", "text").mapInArrow(encode, schema)


def decoded(tokens: DataFrame, model: PieceModel, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, ids, text) and the columns `keep` of `tokens(doc_id, ids)`: the text of the ids, empty
    for no ids or NULL. Other columns are ignored; an empty table gives no rows."""
    shared = tokens.sparkSession.sparkContext.broadcast(model)
    columns = ["doc_id", "ids", *keep]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = [model.decode(ids.as_py() or []) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*columns, "text"]
            )

    given = tokens.select(*columns)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema)
    return given.mapInArrow(decode, f"{schema}, text string")
