"""String similarities from 0 to 1, 0 if a side is empty.

The alignment-based ones are Arrow UDFs, one call for all of them and each pair of strings
computed once in a batch, many pairs together in NumPy; the plain functions of one pair define
them. The set-based ones are native.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..config import STOP_TOKENS
from . import batches
from . import text as T


def lcs_length(a: str, b: str) -> int:
    """The longest common subsequence, bit-parallel over the first string."""
    if len(a) > len(b):
        a, b = b, a
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    state = full
    for c in b:
        hit = state & masks.get(c, 0)
        state = (state + hit | state - hit) & full
    return len(a) - state.bit_count()


#: Letters of a bit mask, masks of a string at most, and pairs of strings that are compared together.
WORD, MASKS, BLOCK = 64, 4, 512
ONES = np.array([(1 << i) - 1 for i in range(WORD + 1)], np.uint64)


def _letters(*sides: list[str]) -> tuple[list[np.ndarray], int]:
    """Each side's strings as rows of letter codes from 1, padded with 0, and the number of codes. No string holds a NUL."""
    found = [np.array(side).reshape(len(side), 1).view(np.uint32) if any(side) else np.zeros((len(side), 1), np.uint32) for side in sides]
    most = max(int(x.max()) for x in found) + 1
    if most > 128:
        letters, codes = np.unique(np.concatenate([[0], *(x.ravel() for x in found)]), return_inverse=True)
        ends = np.cumsum([1, *(x.size for x in found)])
        return [codes[i:j].reshape(x.shape) for i, j, x in zip(ends[:-1], ends[1:], found)], len(letters)
    return [x.astype(np.int64) for x in found], most


def _masks(x: np.ndarray, letters: int) -> np.ndarray:
    """(masks, strings * letters): bit i of a string's masks is set for its letter i; none for padding."""
    rows, out = np.arange(len(x)) * letters, np.zeros((-(-x.shape[1] // WORD), len(x) * letters), np.uint64)
    for i in range(x.shape[1]):
        out[i // WORD][rows + x[:, i]] |= np.uint64(1 << i % WORD)
    out[:, rows] = 0
    return out


def lcs_lengths(a: list[str], b: list[str]) -> np.ndarray:
    """``lcs_length`` of each pair, all pairs together where the shorter string has MASKS words of letters at most."""
    out = np.zeros(len(a), np.int64)
    short, long, at = [], [], []
    for i, (x, y) in enumerate(zip(a, b)):
        x, y = (x, y) if len(x) <= len(y) else (y, x)
        if not x:
            continue
        if len(x) > MASKS * WORD or len(y) > 1000 or "\0" in x or "\0" in y:
            out[i] = lcs_length(x, y)
        else:
            short.append(x)
            long.append(y)
            at.append(i)
    # Of like lengths together, in blocks that the tables of masks keep small.
    order = sorted(range(len(at)), key=lambda i: (len(short[i]) > WORD, len(long[i])))
    for start in range(0, len(order), BLOCK):
        block = order[start : start + BLOCK]
        (x, y), letters = _letters([short[i] for i in block], [long[i] for i in block])
        masks, lengths = _masks(x, letters), np.array([len(short[i]) for i in block])
        full = [ONES[np.clip(lengths - WORD * w, 0, WORD)] for w in range(len(masks))]
        state = [f.copy() for f in full]
        for seen in (y + np.arange(len(block))[:, None] * letters).T.copy():
            carry = None
            for w, mask in enumerate(masks):
                hit = state[w] & mask.take(seen)
                more = state[w] + hit
                if len(masks) > 1:
                    over = more < hit
                    if carry is not None:
                        more += carry
                        over |= more < carry
                    carry = over.astype(np.uint64)
                state[w] = (more | (state[w] - hit)) & full[w]
        out[[at[i] for i in block]] = lengths - sum(np.bitwise_count(x).astype(np.int64) for x in state)
    return out


def ratios(a: list[str], b: list[str]) -> list[float]:
    """``ratio`` of each pair."""
    return [(2 * n / (len(x) + len(y)) if x and y else 0.0) for x, y, n in zip(a, b, lcs_lengths(a, b).tolist())]


def ratio(a: str, b: str) -> float:
    """Twice the common subsequence over both lengths."""
    if not a or not b:
        return 0.0
    return 1.0 if a == b else 2 * lcs_length(a, b) / (len(a) + len(b))


def token_sort(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def _parts(a: str, b: str) -> tuple[list[str], list[str], list[str]]:
    x, y = set(a.split()), set(b.split())
    return sorted(x & y), sorted(x - y), sorted(y - x)


def token_set(a: str, b: str, parts: tuple[list[str], list[str], list[str]] | None = None, lcs: int | None = None) -> float:
    """The best of: the rests side by side, and either whole set against the common words.

    ``parts`` and the common subsequence of the rests may be known.
    """
    if not a or not b:
        return 0.0
    both, only_a, only_b = parts or _parts(a, b)
    if not both and not (only_a and only_b):
        return 0.0
    if both and not (only_a and only_b):
        return 1.0
    left, right, common = " ".join(only_a), " ".join(only_b), len(" ".join(both))
    gap = 1 if common else 0
    size_a, size_b = common + gap + len(left), common + gap + len(right)
    distance = len(left) + len(right) - 2 * (lcs_length(left, right) if lcs is None else lcs)
    best = 1 - distance / (size_a + size_b)
    if common:
        best = max(best, 1 - (gap + len(left)) / (common + size_a), 1 - (gap + len(right)) / (common + size_b))
    return best


def partial_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter string against windows of its length in the longer, cut ones at the ends included."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0

    def best(short: str, long: str) -> float:
        n, found = len(short), 0.0
        letters = set(short)
        for end in range(1, len(long) + n):
            window = long[max(0, end - n) : end]
            # A best window starts and ends with a letter of the short string.
            if window[-1] in letters or window[0] in letters:
                found = max(found, ratio(short, window))
                if found == 1.0:
                    break
        return found

    if len(a) == len(b):
        return max(best(a, b), best(b, a))
    return best(a, b) if len(a) < len(b) else best(b, a)


def partial_ratios(a: list[str], b: list[str]) -> list[float]:
    """``partial_ratio`` of each pair, the windows of many pairs together where the shorter string fits a mask."""
    out, sides = np.zeros(len(a)), []
    for i, (x, y) in enumerate(zip(a, b)):
        if not x or not y or x == y or min(len(x), len(y)) > WORD or max(len(x), len(y)) > 1000 or "\0" in x or "\0" in y:
            out[i] = partial_ratio(x, y)
            continue
        if len(x) <= len(y):
            sides.append((x, y, i))
        if len(x) >= len(y):
            sides.append((y, x, i))
    # The longest first: of a block's windows those that still have letters are the first ones.
    sides.sort(key=lambda s: -len(s[0]))
    for start in range(0, len(sides), BLOCK // 4):
        block = sides[start : start + BLOCK // 4]
        (x, y), letters = _letters([s[0] for s in block], [s[1] for s in block])
        mask = _masks(x, letters)[0]
        n, size = (np.array([len(s[k]) for s in block]) for k in (0, 1))
        codes = y + np.arange(len(block))[:, None] * letters
        met = mask[codes] != 0
        counts = n + size - 1
        row = np.repeat(np.arange(len(block)), counts)
        end = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + 1
        low, high = np.maximum(0, end - n[row]), np.minimum(end, size[row])
        # A best window starts and ends with a letter of the short string.
        fine = met[row, low] | met[row, high - 1]
        row, end, low, high = row[fine], end[fine], low[fine], high[fine]
        wide = int(n[0])
        padded = np.repeat(np.arange(len(block))[:, None] * letters, y.shape[1] + 2 * wide, axis=1)
        padded[:, wide : wide + y.shape[1]] = codes
        padded, first = padded.ravel(), row * (y.shape[1] + 2 * wide) + end + wide - n[row]
        full = ONES[n[row]]
        state = full.copy()
        for j, active in enumerate(np.searchsorted(-n[row], -np.arange(wide), "left")):
            held = state[:active]
            hit = held & mask.take(padded.take(first[:active] + j))
            state[:active] = ((held + hit) | (held - hit)) & full[:active]
        found = 2 * (n[row] - np.bitwise_count(state)) / (n[row] + high - low)
        np.maximum.at(out, np.array([s[2] for s in block])[row], found)
    return out.tolist()


def partial_token_ratio(a: str, b: str) -> float:
    both, only_a, only_b = _parts(a, b)
    if both:
        return 1.0
    found = partial_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))
    if len(only_a) == len(a.split()) and len(only_b) == len(b.split()):
        return found
    return max(found, partial_ratio(" ".join(only_a), " ".join(only_b)))


def weighted_ratio(a: str, b: str) -> float:
    """The best of the ratios above, token and partial ones weighted down by how unlike the lengths are."""
    if not a or not b:
        return 0.0
    unlike = max(len(a), len(b)) / min(len(a), len(b))
    plain = ratio(a, b)
    if unlike < 1.5:
        return max(plain, 0.95 * max(token_sort(a, b), token_set(a, b)))
    scale = 0.6 if unlike > 8 else 0.9
    return max(plain, scale * partial_ratio(a, b), 0.95 * scale * partial_token_ratio(a, b))


def weighted_ratios(a: list[str], b: list[str], plain: list[float], sort: list[float], set_: list[float]) -> list[float]:
    """``weighted_ratio`` of each pair whose ratio, token sort and token set are known."""
    out, far = [], []
    for i, (x, y, r, t, u) in enumerate(zip(a, b, plain, sort, set_)):
        if x and y and max(len(x), len(y)) / min(len(x), len(y)) >= 1.5:
            far.append(i)
        out.append(max(r, 0.95 * max(t, u)) if x and y else 0.0)
    if not far:
        return out
    x, y = [a[i] for i in far], [b[i] for i in far]
    parts = [_parts(*p) for p in zip(x, y)]
    words = [1.0] * len(far)
    apart = [k for k, p in enumerate(parts) if not p[0]]
    sorted_, rest = ([" ".join(sorted(side[k].split())) for k in apart] for side in (x, y)), ([" ".join(parts[k][i]) for k in apart] for i in (1, 2))
    for k, one, other in zip(apart, partial_ratios(*sorted_), partial_ratios(*rest)):
        whole = len(parts[k][1]) == len(x[k].split()) and len(parts[k][2]) == len(y[k].split())
        words[k] = one if whole else max(one, other)
    for k, (i, part) in enumerate(zip(far, partial_ratios(x, y))):
        scale = 0.6 if max(len(x[k]), len(y[k])) / min(len(x[k]), len(y[k])) > 8 else 0.9
        out[i] = max(plain[i], scale * part, 0.95 * scale * words[k])
    return out


def jaro_winkler(a: str, b: str) -> float:
    """Jaro similarity, raised by a tenth per common leading letter (four at most) where it exceeds 0.7."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    taken = [False] * len(b)
    left = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                left.append(c)
                break
    if not left:
        return 0.0
    right = [c for c, t in zip(b, taken) if t]
    moved = sum(x != y for x, y in zip(left, right)) // 2
    m = len(left)
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    if jaro <= 0.7:
        return jaro
    prefix = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro)


def jaro_winkler_all(a: list[str], b: list[str]) -> list[float]:
    """``jaro_winkler`` of each pair, all pairs together where the second string fits two masks."""
    out, at = np.zeros(len(a)), []
    for i, (x, y) in enumerate(zip(a, b)):
        if not x or not y or x == y or len(y) > 2 * WORD or len(x) > 1000 or "\0" in x or "\0" in y:
            out[i] = jaro_winkler(x, y)
        else:
            at.append(i)
    at.sort(key=lambda i: (len(b[i]) > WORD, len(a[i])))
    for start in range(0, len(at), BLOCK):
        block = at[start : start + BLOCK]
        (x, y), letters = _letters([a[i] for i in block], [b[i] for i in block])
        masks = _masks(y, letters)
        m, n = (np.array([len(side[i]) for i in block]) for side in (a, b))
        reach = np.maximum(0, np.maximum(m, n) // 2 - 1)
        taken = [np.zeros(len(block), np.uint64) for _ in masks]
        matched = np.zeros(x.shape, bool)
        for i, seen in enumerate((x + np.arange(len(block))[:, None] * letters).T.copy()):
            low, high = np.maximum(0, i - reach), np.minimum(n, i + reach + 1)
            free = np.ones(len(block), bool)
            for w, mask in enumerate(masks):
                near = ONES[np.clip(high - WORD * w, 0, WORD)] & ~ONES[np.clip(low - WORD * w, 0, WORD)]
                hit = np.where(free, mask.take(seen) & near & ~taken[w], np.uint64(0))
                hit &= ~hit + np.uint64(1)
                taken[w] |= hit
                free &= hit == 0
            matched[:, i] = ~free
        bits = np.concatenate([t[:, None] >> np.arange(WORD, dtype=np.uint64) & np.uint64(1) for t in taken], axis=1)[:, : y.shape[1]].astype(bool)
        # Both sides' matches follow one another row by row, as many in a row on either side.
        both = matched.sum(axis=1)
        moved = np.bincount(np.repeat(np.arange(len(block)), both), x[matched] != y[bits], len(block)) // 2
        some = np.maximum(both, 1)
        jaro = np.where(both > 0, (both / m + both / n + (both - moved) / some) / 3, 0.0)
        head = min(4, x.shape[1], y.shape[1])
        same = (x[:, :head] == y[:, :head]) & (x[:, :head] != 0)
        prefix = np.minimum.accumulate(same, axis=1).sum(axis=1)
        out[block] = np.where(jaro > 0.7, jaro + prefix * 0.1 * (1 - jaro), jaro)
    return out.tolist()


KERNELS = {"ratio": ratio, "wratio": weighted_ratio, "token_set": token_set, "token_sort": token_sort, "jaro_winkler": jaro_winkler}


def _struct(*names: str) -> StructType:
    return StructType([StructField(n, DoubleType()) for n in names])


def _jaccard_of(x: set[str], y: set[str]) -> float:
    return len(x & y) / len(x | y) if x and y else 0.0


def token_jaccard(a: str, b: str) -> float:
    """``set_jaccard`` of the tokens."""
    return _jaccard_of(*({w for w in t.split(" ") if len(w) >= 3 and w not in STOP_TOKENS} for t in (a, b)))


def digit_jaccard(a: str, b: str) -> float:
    """``set_jaccard`` of the numbers."""
    return _jaccard_of(*(set(batches.DIGITS(t)) for t in (a, b)))


def gram_jaccard(a: str, b: str) -> float:
    """``char_jaccard`` of two strings."""
    if not a or not b:
        return 0.0
    x, y = a.replace(" ", ""), b.replace(" ", "")
    grams, others = ({t[i : i + 3] for i in range(len(t) - 2)} for t in (x, y))
    return _jaccard_of(grams, others) if grams and others else ratio(x, y)


def acronym_match(a: str, b: str) -> float:
    one, other = ([w for w in t.split(" ") if w] for t in (a, b))
    return float(len(one) > 1 and [w[0] for w in one] == [w[0] for w in other])


#: Those of the above that have native columns too.
SETS = {"char_jaccard": gram_jaccard, "token_jaccard": token_jaccard, "digit_jaccard": digit_jaccard, "acronym_match": acronym_match}


def _any_scores(x: list[str], y: list[str], names: list[str]) -> dict[str, list[float]]:
    """The named similarities of different pairs of any strings; all common subsequences together."""
    found: dict[str, list[float]] = {n: list(map(SETS[n], x, y)) for n in names if n in SETS}
    wratio = "wratio" in names
    if wratio or "ratio" in names:
        found["ratio"] = ratios(x, y)
    if wratio or "token_sort" in names:
        found["token_sort"] = ratios(*([" ".join(sorted(t.split())) for t in side] for side in (x, y)))
    if wratio or "token_set" in names:
        parts = [_parts(*p) for p in zip(x, y)]
        lcs = lcs_lengths([" ".join(p[1]) for p in parts], [" ".join(p[2]) for p in parts]).tolist()
        found["token_set"] = [token_set(*p, q, n) for *p, q, n in zip(x, y, parts, lcs)]
    if wratio:
        found["wratio"] = weighted_ratios(x, y, found["ratio"], found["token_sort"], found["token_set"])
    if "jaro_winkler" in names:
        found["jaro_winkler"] = jaro_winkler_all(x, y)
    return {n: found[n] for n in names}


def _scores(a: pd.Series, b: pd.Series, names: list[str]) -> pd.DataFrame:
    """The named similarities; each pair of strings once, those of plain short strings by their numbers (``batches``)."""
    known: dict[str, int] = {}
    at = np.array([known.setdefault(t, len(known)) for side in (a, b) for t in side.fillna("")], np.int64)
    texts = list(known)
    pairs, rows = np.unique(at[: len(a)] * len(texts) + at[len(a) :], return_inverse=True)
    x, y = pairs // max(len(texts), 1), pairs % max(len(texts), 1)
    found = {n: np.zeros(len(pairs)) for n in names}
    plain = np.array([batches.fits(t) for t in texts], bool)
    together = plain[x] & plain[y]
    if "wratio" in names:
        size = np.array([len(t) for t in texts], np.int64)
        together &= (size[x] == 0) | (size[y] == 0) | (np.maximum(size[x], size[y]) < 1.5 * np.minimum(size[x], size[y]))
    for chosen, fine in ((np.flatnonzero(together), True), (np.flatnonzero(~together), False)):
        if len(chosen):
            used, numbers = np.unique(np.concatenate([x[chosen], y[chosen]]), return_inverse=True)
            strings, one, other = [texts[i] for i in used], numbers[: len(chosen)], numbers[len(chosen) :]
            got = batches.compare(strings, one, other, names) if fine else _any_scores([strings[i] for i in one], [strings[i] for i in other], names)
            for n in names:
                found[n][chosen] = got[n]
    return pd.DataFrame({n: v[rows] for n, v in found.items()})


@F.pandas_udf(_struct("ratio", "wratio", "token_set"))
def lexical(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """Those that rank and decide: ratio, weighted ratio and token set."""
    return _scores(a, b, ["ratio", "wratio", "token_set"])


@F.pandas_udf(_struct("ratio", "token_sort"))
def aligned(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """Ratio, plain and of sorted words."""
    return _scores(a, b, ["ratio", "token_sort"])


@F.pandas_udf(DoubleType())
def jaro_winklers(a: pd.Series, b: pd.Series) -> pd.Series:
    return _scores(a, b, ["jaro_winkler"])["jaro_winkler"]


@F.pandas_udf(DoubleType())
def safe_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return _scores(a, b, ["ratio"])["ratio"]


def best_lexical(a: Column | str, b: Column | str) -> Column:
    found = lexical(a, b)
    return F.greatest(found["ratio"], found["wratio"], found["token_set"])


def set_jaccard(a: Column | str, b: Column | str) -> Column:
    a, b = T._column(a), T._column(b)
    both = F.size(F.array_intersect(a, b)).cast("double")
    return F.when((F.size(a) > 0) & (F.size(b) > 0), both / F.size(F.array_union(a, b))).otherwise(F.lit(0.0))


def gram_codes(text: Column | str) -> Column:
    """The distinct trigrams of a text without spaces as longs, 21 bits a letter: made once for a record, they are compared without strings."""

    def of(t: Column) -> Column:
        count = F.length(t) - 2
        letter = lambda i: F.ascii(F.substring(t, i, F.lit(1))).cast("long")
        code = lambda i: F.shiftleft(letter(i), 42).bitwiseOR(F.shiftleft(letter(i + 1), 21)).bitwiseOR(letter(i + 2))
        return F.when(count > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), code))).otherwise(F.array().cast("array<bigint>"))

    # A lambda over one element: the text without spaces is made once, not for every letter.
    return F.transform(F.array(T.compact(text)), of)[0]


def short_ratio(a: Column, b: Column) -> Column:
    """``safe_ratio`` of strings of which one has two letters at most, without Python."""

    def of(brief: Column, other: Column) -> Column:
        one, two = F.substring(brief, 1, 1), F.substring(brief, 2, 1)
        rest = F.substring(other, F.instr(other, one) + 1, F.length(other))
        either = F.contains(other, one) | ((two != "") & F.contains(other, two))
        common = F.when((two != "") & F.contains(other, one) & F.contains(rest, two), 2).otherwise(either.cast("int"))
        return F.when((brief == "") | (other == ""), F.lit(0.0)).otherwise(2.0 * common / (F.length(brief) + F.length(other)))

    # Lambdas over one element are calls: what is rarely needed doesn't swell the code of the loop around it.
    ordered = lambda p: F.when(F.length(p["x"]) <= F.length(p["y"]), p).otherwise(F.struct(p["y"].alias("x"), p["x"].alias("y")))
    return F.transform(F.transform(F.array(F.struct(a.alias("x"), b.alias("y"))), ordered), lambda p: of(p["x"], p["y"]))[0]


def char_jaccard(a: Column | str, b: Column | str, codes: tuple[Column | str, Column | str] | None = None) -> Column:
    """Shared trigrams of the strings without spaces; shorter strings are compared by their ratio. ``codes``: both sides' ``gram_codes``."""
    a, b = T._column(a), T._column(b)
    x, y = (T._column(c) for c in codes) if codes else (gram_codes(a), gram_codes(b))
    both = F.size(F.array_intersect(x, y)).cast("double")
    # Strings without trigrams are the short ones.
    short = F.when((a == "") | (b == ""), F.lit(0.0)).otherwise(short_ratio(T.compact(a), T.compact(b)))
    return F.when((F.size(x) > 0) & (F.size(y) > 0), both / (F.size(x) + F.size(y) - both)).otherwise(F.coalesce(short, F.lit(0.0)))
