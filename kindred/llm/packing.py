"""Packing documents into token sequences by online sum-of-squares (Csirik et al. 2006).

A document's full windows leave at once; its rest goes to the open window whose fill level
keeps the sum of the squared numbers of open windows by level smallest. Each partition
packs its own rows in one pass and in bounded memory, without a shuffle. At its end the
windows that are still open are joined by cutting, so that one partial window is left.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import id_lists, in_arrow
from ._parts import Table, pieces_of, side_by_side

#: White_Space of Unicode, as the pre-tokenizer's \s has it.
SPACE = "\t\n\x0b\x0c\r \x85\xa0                　"
#: Beyond these characters the two libraries' Unicode tables could differ.
RARE = re.compile("[^\0-ɏ‐-‧]")
END_ID = 1
SCHEMA = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>"


class ByteTokenizer:
    """Token ids of whole texts by a byte-level BPE, each distinct part of a batch looked at once.

    No token spans from a non-space character into the space after it, so a text cut before
    its single spaces is the concatenation of its parts. New parts are encoded together, as
    one text in the vocabulary's rank form, and cut by their lengths. Texts with other white
    space at such a place, parts with special tokens and rare characters go to the tokenizers
    library as they are. The table of parts is bounded in bytes.
    """

    def __init__(self, path: str, ranks: str):
        import tiktoken
        from public_tokenizers import PATTERN

        self.path, self.tokenizer = path, None
        with open(path, encoding="utf-8") as f:
            spec = f.read()
        # Only this list of the file; the rest, decoded, would take many times its size.
        found = re.search(r'"added_tokens"\s*:\s*', spec)
        self.special = [t["content"] for t in json.JSONDecoder().raw_decode(spec, found.end())[0]] if found else []
        del spec
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("parts", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.sizes = np.zeros(max(table.values()) + 1, np.int64)
        for token, rank in table.items():
            self.sizes[rank] = len(token)
        self.known = Table(self.learn)

    def direct(self, text: str) -> bytes:
        if self.tokenizer is None:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(self.path)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def odd(self, part: str) -> bool:
        return RARE.search(part) is not None or any(s in part for s in self.special)

    def first(self, part: str) -> bytes:
        return self.direct(part) if self.odd(part) else np.array(self.encoding.encode_ordinary(part), "<u4").tobytes()

    def learn(self, parts: list[str]) -> list[bytes | None]:
        """The ids of the parts, each after one space; None for parts that can't stand alone."""
        alone = [p and p[0] not in SPACE and p[-1] not in SPACE for p in parts]
        plain = [p for p, a in zip(parts, alone) if a]
        together, out = " ".join(plain), {}
        if self.odd(together):
            out = {p: self.direct(" " + p) for p in plain if self.odd(p)}
            plain = [p for p in plain if p not in out]
            together = " ".join(plain)
        if plain:
            ids = np.array(self.encoding.encode_ordinary(" " + together), "<u4")
            sizes = np.diff(np.frombuffer(pa.array(plain, pa.string()).buffers()[1], np.int32)[: len(plain) + 1].astype(np.int64))
            cuts = [0, *(4 * (np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum(sizes + 1)) + 1)).tolist()]
            raw = ids.tobytes()
            out.update((p, raw[a:b]) for p, a, b in zip(plain, cuts, cuts[1:]))
        return [out.get(p) if a else None for p, a in zip(parts, alone)]

    def token_ids(self, texts: pa.Array, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, each with ``end`` behind it, and where each text begins and the last one ends."""
        split = pc.split_pattern(texts, " ")
        ends = split.offsets.to_numpy().astype(np.int64)
        parts = split.values.slice(ends[0], ends[-1] - ends[0])
        ends -= ends[0]
        heads = parts.take(pa.array(ends[:-1]))
        encoded = parts.dictionary_encode()
        distinct = self.known.look_up(encoded.dictionary)
        codes = encoded.indices.to_numpy()
        # A text's first part has no space before it; a text with a part that can't stand alone is encoded as a whole.
        alone = distinct.is_valid().to_numpy(zero_copy_only=False)[codes]
        alone[ends[:-1]] = True
        whole = np.minimum.reduceat(alone, ends[:-1]) if len(alone) else np.ones(0, bool)
        own, more = {}, [end]
        codes = np.insert(codes, ends[1:], len(distinct)).astype(np.int64)
        ends = ends + np.arange(len(ends))
        for i, head in enumerate(heads.to_pylist()):
            at, to = ends[i], ends[i + 1] - 1
            if not whole[i] or (to - at > 1 and head[-1:] and head[-1] in SPACE):
                codes[at : to] = len(distinct) + 1
                more.append(self.direct(texts[i].as_py()))
                codes[at] = len(distinct) + len(more)
            else:
                if head not in own:
                    more.append(self.first(head) if head else b"")
                    own[head] = len(distinct) + len(more)
                codes[at] = own[head]
        return side_by_side(pa.concat_arrays([distinct, pa.array([more[0], b"", *more[1:]], pa.large_binary())]), codes, ends)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        ids, ends = self.token_ids(pa.array(texts, pa.string()))
        for a, b in zip(ends, ends[1:]):
            yield ids[a:b].tobytes()


_tokenizers: dict[tuple[str, str], ByteTokenizer] = {}


def byte_tokenizer(path: str, ranks: str) -> ByteTokenizer:
    """One tokenizer for all tasks of a worker."""
    if (path, ranks) not in _tokenizers:
        _tokenizers[path, ranks] = ByteTokenizer(path, ranks)
    return _tokenizers[path, ranks]


class Packer:
    """Sum-of-squares packing of token strings into windows; ``put`` and ``close`` return finished pieces.

    A piece is (doc, start, ids, doc_tokens, sequence, offset).
    """

    def __init__(self, size: int, first_sequence: int):
        self.size, self.next = size, first_sequence
        self.levels = np.zeros(size + 1, np.int64)
        self.open: dict[int, list[list]] = {}

    def new(self) -> int:
        self.next += 1
        return self.next - 1

    def level_for(self, rest: int) -> int:
        """The fill level to add to, 0 for a new window; among equals the fullest."""
        own, then = self.levels[1 : self.size - rest + 1], self.levels[1 + rest :]
        held = np.flatnonzero(own)
        if not len(held):
            return 0
        change = 2 * (then[held] - own[held]) + 2
        if held[-1] == self.size - rest - 1:
            change[-1] = 1 - 2 * own[-1]  # the window is full and leaves
        at = len(change) - 1 - int(np.argmin(change[::-1]))
        best = int(held[at])
        return best + 1 if change[at] <= 2 * self.levels[rest] + 1 else 0

    def put(self, doc, ids: bytes) -> Iterator[tuple]:
        total, at = len(ids) // 4, 0
        while total - at >= self.size:
            yield doc, at, ids[4 * at : 4 * (at + self.size)], total, self.new(), 0
            at += self.size
        if at == total:
            return
        rest = total - at
        level = self.level_for(rest)
        window = self.open[level].pop() if level else []
        window.append((doc, at, ids[4 * at :], total))
        if level:
            self.levels[level] -= 1
        if level + rest == self.size:
            yield from self.finished(window)
        else:
            self.levels[level + rest] += 1
            self.open.setdefault(level + rest, []).append(window)

    def finished(self, window: list) -> Iterator[tuple]:
        sequence, offset = self.new(), 0
        for doc, start, ids, total in window:
            yield doc, start, ids, total, sequence, offset
            offset += len(ids) // 4

    def close(self) -> Iterator[tuple]:
        """Move the emptiest windows' tokens into the gaps of the fullest, until one is left."""
        left = [[level, window] for level in sorted(self.open, reverse=True) for window in self.open[level]]
        self.open, self.levels[:] = {}, 0
        low = 0
        while low < len(left):
            filled, window = left[low]
            while filled < self.size and len(left) > low + 1:
                doc, start, ids, total = left[-1][1].pop()
                take = min(self.size - filled, len(ids) // 4)
                window.append((doc, start, ids[: 4 * take], total))
                filled += take
                if 4 * take < len(ids):
                    left[-1][1].append((doc, start + take, ids[4 * take :], total))
                left[-1][0] -= take
                if not left[-1][1]:
                    left.pop()
            yield from self.finished(window)
            low += 1


def pack(docs: DataFrame, tokenizer: str, ranks: str, doc_id: str = "doc_id", text: str = "text", size: int = 2048) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (array<int>).

    Every document is its ids and then END_ID, so a null or empty text is one token.
    sequence_id is unique over all partitions (the partition's number and a count); a
    sequence is complete but for one in each partition. Repeated rows and ids are packed
    like any others, no other column is read, and a very long text is held a few times over
    by one task.
    """
    kind = dict(docs.dtypes)[doc_id]
    end = np.array([END_ID], "<u4").tobytes()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    id_type = pa.int64() if kind == "bigint" else None

    def run(batches):
        packer = Packer(size, TaskContext.get().partitionId() << 40)
        coder = byte_tokenizer(tokenizer, ranks)
        rows: list[tuple] = []

        def flush():
            for at in range(0, len(rows), 2048):
                docs_, starts, ids, totals, sequences, offsets = zip(*rows[at : at + 2048])
                ends = np.cumsum([0, *map(len, ids)]) // 4
                longs = [pa.array(c, pa.int64()) for c in (starts, np.diff(ends), list(map(zlib.crc32, ids)), totals, sequences, offsets)]
                yield pa.RecordBatch.from_arrays([pa.array(docs_, id_type), *longs, id_lists(np.frombuffer(b"".join(ids), "<u4"), ends)], names=names)
            rows.clear()

        for batch in batches:
            for part in pieces_of(batch, 1):
                ids, ends = coder.token_ids(part.column(1), end)
                raw, ends = ids.tobytes(), (4 * ends).tolist()
                for doc, a, b in zip(part.column(0).to_pylist(), ends, ends[1:]):
                    rows.extend(packer.put(doc, raw[a:b]))
                yield from flush()
        rows.extend(packer.close())
        yield from flush()

    return in_arrow(docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")), run, f"doc_id {kind}, {SCHEMA}")
