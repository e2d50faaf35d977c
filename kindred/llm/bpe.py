"""BPE encoding and decoding by a prefix-sharing trie traversal.

The encoding of a word's prefix ends in one token; that token and the place where it begins
are the prefix's whole state, for what stands before it is the encoding of a shorter prefix.
A token t may follow the last token p of a prefix exactly if p and t, put side by side, would
not merge across their seam. So the distinct words of a batch go into a trie, one depth-first
walk gives every node its last token, and shared prefixes are encoded once.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import id_lists, map_arrow
from ._parts import Table, pieces_of, side_by_side

#: Pairs of tokens and states of the walk that are remembered at most.
SEAMS, STATES = 300_000, 100_000
#: White_Space of Unicode beyond ASCII; what kind of space stands between words is no matter.
OTHER_SPACE = "[\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: The words of the public tokenizer file: contractions, runs of letters, single digits, runs of other marks.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Marks that are words of their own after a word of letters.
PLAIN_ENDS = tuple(".,;:!?")


def byte_letters() -> list[str]:
    """The printable stand-ins of the 256 bytes in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + rest.index(b)) for b in range(256)]


class WordBpe:
    """A tokenizer file of kind word-end BPE: NFC, lower case, split by a pattern, byte letters, merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.mark: str = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern)
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.letters = byte_letters()
        #: The shortcuts in ``pieces`` hold for this pattern only.
        self.plain = pattern == PATTERN
        names = {i: t for t, i in (self.vocab | self.special).items()}
        self.shown = pa.array([names.get(i, "") for i in range(max(names) + 1)], pa.string())
        self.known = Table(self.learn)
        self.states: dict[str, list] = {}
        self._tables([tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]])

    def _tables(self, merges: list[tuple[str, str]]) -> None:
        """Merge ranks, and for each token its pieces along the left and the right edge with the ranks when they last."""
        ids = self.vocab
        self.rank: dict[tuple[int, int], int] = {}
        self.split: dict[int, tuple[int, int, int]] = {}
        inner, final, whole = {}, {}, set()
        for letter in self.letters:
            inner[letter] = ids[letter]
            final[letter] = ids[letter + self.mark]
        whole.update(inner.values(), final.values())
        self.seam: dict[tuple[int, int], bool] = {}
        for n, (a, b) in enumerate(merges):
            self.rank[ids[a], ids[b]] = n
        for n, (a, b) in enumerate(merges):
            out = ids[a + b]
            if out not in self.split:
                self.split[out] = (ids[a], ids[b], n)
        # A token stands for its text only if that text, encoded, is the token.
        for n, (a, b) in enumerate(merges):
            x, y, out = ids[a], ids[b], ids[a + b]
            if self.split[out][2] == n and x in whole and y in whole and not self._crosses(x, y, n):
                whole.add(out)
                if b.endswith(self.mark):
                    final[(a + b)[: -len(self.mark)]] = out
                else:
                    inner[a + b] = out
        self.inner, self.final = inner, final
        self.begins = {token[:n] for token in (*inner, *final) for n in range(len(token) + 1)}

    def _crosses(self, left: int, right: int, before: int = 1 << 30) -> bool:
        """Whether side by side the two tokens would merge across the seam, at a rank below ``before``.

        Seen backwards in time, the pieces at the seam are the right edge of one token and the
        left edge of the other. Whichever was made last is undone first. A merge across the seam
        takes place if its rank comes while both its pieces are there; of equal ranks the one
        further left goes first.
        """
        ends_left = ends_right = before  # ranks at which the pieces are used up
        while True:
            made_left = self.split[left][2] if left in self.split else -1
            made_right = self.split[right][2] if right in self.split else -1
            rank = self.rank.get((left, right))
            if rank is not None and max(made_left, made_right) < rank and rank < ends_left and (rank <= ends_right if ends_right != before else rank < before):
                return True
            if made_left < 0 and made_right < 0:
                return False
            if made_left >= made_right:
                ends_left, left = made_left, self.split[left][1]
            else:
                ends_right, right = made_right, self.split[right][0]

    def may_follow(self, left: int, right: int) -> bool:
        key = (left, right)
        found = self.seam.get(key)
        if found is None:
            if len(self.seam) > SEAMS:
                self.seam.clear()
            found = self.seam[key] = not self._crosses(left, right)
        return found

    def _state(self, text: str) -> list:
        """A node's suffixes that matter: [by the next letter the next state, inner tokens that end here, final ones, text].

        The text is the longest suffix that begins a token; tokens come with their sizes, longest first.
        """
        found = self.states.get(text)
        if found is None:
            if len(self.states) > STATES:
                self.states.clear()
            ends = [text[i:] for i in range(len(text))]
            pick = lambda table: tuple((table[x], len(x)) for x in ends if x in table)
            found = self.states[text] = [{}, pick(self.inner), pick(self.final), text]
        return found

    def _next(self, state: list, letter: str) -> list:
        text = state[3] + letter
        while text not in self.begins:
            text = text[1:]
        found = state[0][letter] = self._state(text)
        return found

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """The ids of distinct words in byte letters, by one depth-first walk through their trie.

        Sorted words are the trie in depth-first order: a node is a depth of the current path, and
        what two neighbours begin with alike is walked once. Each node keeps its last token and the
        depth at which that begins, so a path costs memory in proportion to its length.
        """
        out: dict[str, bytes] = {}
        follow, step = self.may_follow, self._next
        start = self._state("")
        states, last, begin, path = [start], [-1], [0], ""
        for word in sorted(words):
            depth, most = 0, min(len(path), len(word) - 1)
            while depth < most and path[depth] == word[depth]:
                depth += 1
            del states[depth + 1 :], last[depth + 1 :], begin[depth + 1 :]
            path = word[:-1]
            state = states[depth]
            for letter in path[depth:]:
                depth += 1
                state = state[0].get(letter) or step(state, letter)
                states.append(state)
                for token, size in state[1]:
                    at = depth - size
                    if not at or follow(last[at], token):
                        last.append(token)
                        begin.append(at)
                        break
            state, depth = state[0].get(word[-1]) or step(state, word[-1]), len(word)
            for token, size in state[2]:
                at = depth - size
                if not at or follow(last[at], token):
                    ids = [token]
                    while at:
                        ids.append(last[at])
                        at = begin[at]
                    ids.reverse()
                    out[word] = struct.pack(f"<{len(ids)}I", *ids)
                    break
        return out

    def pieces(self, part: str) -> list[str | int]:
        """A part without white space as words in byte letters, and special tokens as their ids."""
        out: list[str | int] = []
        for text in self.at_special.split(part) if self.at_special and "<" in part else [part]:
            if text in self.special:
                out.append(self.special[text])
                continue
            if not text.isascii():
                text = unicodedata.normalize("NFC", text)
            # Letter by letter only where str.lower() looks at a letter's neighbours.
            low = "".join([c.lower() for c in text]) if "Σ" in text else text.lower()
            if self.plain and low.isalpha():
                found = [low]
            elif self.plain and low[-1:] in PLAIN_ENDS and low[:-1].isalpha():
                found = [low[:-1], low[-1]]
            else:
                found = self.words.findall(low)
            for word in found:
                out.append(word if word.isascii() and word.isprintable() else "".join(self.letters[b] for b in word.encode()))
        return out

    def learn(self, parts: list[str]) -> list[bytes]:
        """The ids of parts without white space."""
        cut = [self.pieces(part) for part in parts]
        ids = self.encode_words(list({w for words in cut for w in words if isinstance(w, str)}))
        return [ids[words[0]] if len(words) == 1 and isinstance(words[0], str) else b"".join([ids[w] if isinstance(w, str) else struct.pack("<I", w) for w in words]) for words in cut]

    def token_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text begins and the last one ends."""
        if pc.any(pc.match_substring_regex(texts, OTHER_SPACE)).as_py():
            texts = pc.replace_substring_regex(texts, OTHER_SPACE, " ")
        split = pc.ascii_split_whitespace(texts)
        ends = split.offsets.to_numpy().astype(np.int64)
        parts = split.values.slice(ends[0], ends[-1] - ends[0]).dictionary_encode()
        return side_by_side(self.known.look_up(parts.dictionary), parts.indices.to_numpy(), ends - ends[0])

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """For each text its tokens joined by spaces, word-end marks and special tokens kept."""
        names = self.shown.take(pa.array(ids))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), names), " ")

    def encode(self, texts: list[str]) -> list[list[tuple[bytes, str]]]:
        """For each text the ids and the string that they decode to."""
        ids, ends = self.token_ids(pa.array(texts, pa.string()))
        return [[(ids[a:b].tobytes(), shown)] for a, b, shown in zip(ends, ends[1:], self.decode(ids, ends).to_pylist())]


_models: dict[str, WordBpe] = {}


def word_bpe(path: str) -> WordBpe:
    """One model for all tasks of a worker."""
    if path not in _models:
        _models[path] = WordBpe(path)
    return _models[path]


def decode_ids(model: WordBpe, ids: list[int]) -> str:
    """The string of one text's ids."""
    return model.decode(np.array(ids, "<u4"), np.array([0, len(ids)], np.int64))[0].as_py()


def tokenized(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_tokens, ids (array<int>), the text that they decode to, and the digests of both.

    Null and empty texts have no ids and an empty decoded text. Rows don't meet, so repeated
    rows and ids are no matter, and no other column is read. Texts are whole at any length; a
    word takes memory in proportion to its length.
    """
    kind = dict(docs.dtypes)[doc_id]
    names = ["doc_id", "n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256"]

    def of(batch: pa.RecordBatch):
        model = word_bpe(tokenizer)
        for part in pieces_of(batch, 1):
            ids, ends = model.token_ids(part.column(1))
            shown = model.decode(ids, ends)
            raw = memoryview(np.ascontiguousarray(ids)).cast("B")
            texts, offsets = memoryview(shown.buffers()[2] or b""), np.frombuffer(shown.buffers()[1], np.int32).tolist()
            digests = [[hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(ends.tolist(), ends[1:].tolist())], [hashlib.sha256(texts[a:b]).hexdigest() for a, b in zip(offsets, offsets[1:])]]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(ends)), id_lists(ids, ends), shown, *(pa.array(d, pa.string()) for d in digests)], names=names)

    schema = f"doc_id {kind}, n_tokens long, ids array<int>, decoded string, ids_sha256 string, decoded_sha256 string"
    return map_arrow(docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")), of, schema)


def encoded(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_tokens, and the digests of what ``tokenized`` gives."""
    return tokenized(docs, tokenizer, doc_id, text).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
