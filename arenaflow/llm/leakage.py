"""Problem 7: evaluation passages that leak into training text.

Every shard of the corpus gets an FM-index over its words: suffix array,
Burrows-Wheeler transform in a wavelet matrix for ranks, and suffix positions
sampled every few words. The indexed text is the shard's words followed by
every second of them, so that a pair of words searched backwards is found both
side by side and around one foreign word.

A stretch goes on over single altered, added or dropped words, so from one of
its words to the next it moves by one or two words in the item and in the
document. It therefore crosses every boundary between two of the item's words
by one of three pairs. Of every `min_words` / 2 boundaries in a row the search
takes the one whose pairs the index counts least often; a stretch of
`min_words` words crosses at least one of those. Its pairs are located, extended
word by word in both directions over all such moves, and kept if they reach
`min_words`. No stretch is lost on the way. What is kept goes to an alignment that takes the best stretches in order and gives
the spans to remove.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_DROP = re.compile("[̀-ͯ­​-‏⁠﻿'’‘ʼ´`]+")
_WORD = re.compile(r"[^\W_]+")

#: Items that are collected and broadcast at a time; a block is this bound times an item's length.
ITEMS_PER_BLOCK = 5_000
#: Located occurrences that are joined at a time, and places that are extended at a time, each of which may have some dozen ways on.
HITS_AT_ONCE, PLACES_AT_ONCE = 400_000, 100_000
#: A stretch's moves to its next word, (item words, document words): all right, one altered, one added, one dropped.
MOVES = ((1, 1), (2, 2), (1, 2), (2, 1))


def words_of(text: str) -> list[str]:
    """The words without case, accents, punctuation and differences of Unicode form; an apostrophe does not part a word."""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text)
    text = _DROP.sub("", text.casefold() if not text.isascii() else text.lower())
    return _WORD.findall(text if text.isascii() else _DROP.sub("", unicodedata.normalize("NFKD", text)))


@functools.lru_cache(maxsize=4096)
def _plain(ch: str) -> str:
    """What words_of makes of a character."""
    return _DROP.sub("", unicodedata.normalize("NFKD", _DROP.sub("", unicodedata.normalize("NFKD", ch).casefold())))


def word_places(text: str) -> list[tuple[int, int]]:
    """Per word of words_of its range of characters [from, to) in the text as it stands."""
    if text.isascii() and not _DROP.search(text):
        return [m.span() for m in _WORD.finditer(text)]
    plain = [_plain(ch) for ch in text]
    origin = [at for at, ch in enumerate(plain) for _ in ch]
    return [(origin[m.start()], origin[m.end() - 1] + 1) for m in _WORD.finditer("".join(plain))]


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array of an integer sequence by prefix doubling; its last symbol must be the smallest and occur once."""
    n = len(s)
    _, rank = np.unique(s, return_inverse=True)
    rank = rank.astype(np.int64)
    k = 1
    packed = n < 1 << 21
    at = np.arange(n, dtype=np.int64)
    while True:
        nxt = np.zeros(n, np.int64)
        nxt[: n - k] = rank[k:] + 1
        if packed:  # both ranks and the position in one word: one plain sort
            key = np.sort((rank << 42) | (nxt << 21) | at)
            sa = key & ((1 << 21) - 1)
            key >>= 21
        else:
            key = rank * (n + 1) + nxt
            sa = np.argsort(key, kind="stable")
            key = key[sa]
        new = np.empty(n, np.int64)
        new[sa] = np.cumsum(np.r_[0, key[1:] != key[:-1]])
        rank = new
        if rank[sa[-1]] == n - 1:
            return sa
        k *= 2


class WaveletMatrix:
    """Ranks of any symbol in a sequence, with one cumulative bit count per bit of the symbols."""

    def __init__(self, seq: np.ndarray, n_bits: int):
        self.n_bits = n_bits
        self.counts, self.zeros = [], []
        for bit in range(n_bits - 1, -1, -1):
            b = (seq >> bit) & 1
            self.counts.append(np.concatenate([[0], np.cumsum(b, dtype=np.int32)]).astype(np.int32))
            self.zeros.append(int(len(seq) - self.counts[-1][-1]))
            seq = np.concatenate([seq[b == 0], seq[b == 1]])

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        lo, hi = np.zeros_like(upto), upto
        for level, bit in enumerate(range(self.n_bits - 1, -1, -1)):
            one = ((symbol >> bit) & 1).astype(bool)
            a, b = self.counts[level][lo], self.counts[level][hi]
            lo = np.where(one, self.zeros[level] + a, lo - a)
            hi = np.where(one, self.zeros[level] + b, hi - b)
        return hi - lo

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at the positions and their ranks there."""
        symbol = np.zeros(len(at), np.int64)
        lo = np.zeros_like(at)
        for level in range(self.n_bits):
            c = self.counts[level][at]
            one = self.counts[level][at + 1] > c
            symbol = (symbol << 1) | one
            a = self.counts[level][lo]
            lo = np.where(one, self.zeros[level] + a, lo - a)
            at = np.where(one, self.zeros[level] + c, at - c)
        return symbol, at - lo


class FMIndex:
    """Full-text index of an integer sequence with symbols from 1; 0 is the end mark it appends."""

    def __init__(self, s: np.ndarray, sigma: int, every: int = 4):
        s = np.append(s, 0)
        sa = suffix_array(s)
        bwt = s[sa - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=sigma))])
        self.wm = WaveletMatrix(bwt, max(1, int(sigma - 1).bit_length()))
        kept = sa % every == 0
        self.sampled = np.concatenate([[0], np.cumsum(kept)])
        self.is_sampled, self.positions = kept, sa[kept]
        self.n = len(s)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals [lo, hi) of the patterns, rows of equally many symbols, by backward search."""
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        live = np.arange(len(patterns))
        for j in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[live, j]
            a = self.first[c] + self.wm.rank(c, lo[live])
            b = self.first[c] + self.wm.rank(c, hi[live])
            lo[live], hi[live] = a, b
            live = live[a < b]
        hi[lo > hi] = lo[lo > hi]
        dead = np.ones(len(patterns), bool)
        dead[live] = False
        hi[dead] = lo[dead]
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows: walk left until a sampled position."""
        out, steps = np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64)
        left, at = np.arange(len(rows)), rows.copy()
        while len(left):
            done = self.is_sampled[at]
            out[left[done]] = self.positions[self.sampled[at[done]]] + steps[left[done]]
            left, at = left[~done], at[~done]
            symbol, rank = self.wm.access(at)
            at = self.first[symbol] + rank
            steps[left] += 1
        return out


def aligned_stretches(item: list, doc: list, least: int) -> list[tuple[int, int, int, int, int]]:
    """Stretches (words, item from, to, document from, to) in the order of both and without overlap, each of at least `least` common words, that together have the most words."""
    where: dict = {}
    for j, w in enumerate(doc):
        where.setdefault(w, []).append(j)
    # State (i, j, c): the current stretch ends with item word i at document word j and has c words, counted up to `least`.
    # best: (words of all stretches so far, state before or the closed state that a new stretch follows, whether it is new).
    best: dict[tuple[int, int, int], tuple[int, tuple | None, bool]] = {}
    ends_at: dict[tuple[int, int], list[int]] = {}  # the counts c known at (i, j)
    closed: list[tuple[int, int, tuple]] = []  # (document word, words, state), ascending in both: the best closed chains of earlier item words
    for i, w in enumerate(item):
        done = []
        for j in where.get(w, ()):
            got: dict[int, tuple[int, tuple | None, bool]] = {}
            before = None
            for jj, n, state in closed:
                if jj >= j:
                    break
                before = (n, state)
            got[1] = (1 + before[0], before[1], True) if before else (1, None, True)
            for di, dj in MOVES:
                for c in ends_at.get((i - di, j - dj), ()):
                    key = (i - di, j - dj, c)
                    n, c = best[key][0] + 1, min(c + 1, least)
                    if c not in got or n > got[c][0]:
                        got[c] = (n, key, False)
            for c, x in got.items():
                best[(i, j, c)] = x
            ends_at[(i, j)] = list(got)
            if least in got:
                done.append((j, got[least][0], (i, j, least)))
        for entry in done:
            closed.append(entry)
        if done:
            closed.sort(key=lambda x: (x[0], -x[1]))
            top, kept = 0, []
            for entry in closed:
                if entry[1] > top:
                    top = entry[1]
                    kept.append(entry)
            closed = kept
    if not closed:
        return []
    chain, state = [], closed[-1][2]
    while state is not None:
        end, n = state, best[state][0]
        while not best[state][2]:
            state = best[state][1]
        before = best[state][1]
        chain.append((n - (best[before][0] if before else 0), state[0], end[0] + 1, state[1], end[1] + 1))
        state = before
    return chain[::-1]


class _Items:
    """The items' words, and per boundary between two of them the pairs that a stretch may cross it by."""

    def __init__(self, rows: list[tuple[int, str]], min_words: int):
        kept = [(i, words_of(t)) for i, t in rows]
        kept = [(i, w) for i, w in kept if len(w) >= min_words]
        self.ids = [i for i, _ in kept]
        self.words = [w for _, w in kept]
        self.vocabulary = sorted({w for x in self.words for w in x})
        code = {w: k for k, w in enumerate(self.vocabulary)}
        self.length = np.array([len(w) for w in self.words], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.codes = np.array([code[w] for x in self.words for w in x], np.int64)
        of = np.repeat(np.arange(len(self.words)), self.length)
        at = np.arange(len(self.codes)) - self.start[of] if len(of) else of
        # Any min_words words in a row have min_words - 1 boundaries, among them all of a group of half as many.
        group = self.group = min_words // 2
        pairs, boundary, place = [], [], []
        for left, right in ((0, 1), (-1, 1), (0, 2)):  # words before and after the boundary that follows word `at`
            ok = np.flatnonzero((at + left >= 0) & (at + right < self.length[of]))
            pairs.append(np.stack([self.codes[ok + left], self.codes[ok + right]], axis=1))
            boundary.append(ok)
            place.append(ok + left)
        pairs = np.concatenate(pairs).reshape(-1, 2)
        self.boundary, self.place = np.concatenate(boundary), np.concatenate(place)
        self.pairs, self.pair = np.unique(pairs, axis=0, return_inverse=True) if len(pairs) else (pairs, np.zeros(0, np.int64))
        self.pair = self.pair.reshape(-1)
        self.of, self.at = of, at
        self.group_of = np.cumsum(np.r_[True, (of[1:] != of[:-1]) | (at[1:] % group == 0)]) - 1 if len(of) else of


class _Shard:
    """The FM-index of some documents' words."""

    def __init__(self, docs: list[list[str]]):
        self.symbol: dict[str, int] = {}
        number = self.symbol.setdefault
        self.docs = [np.array([number(w, len(self.symbol) + 2) for w in d], np.int64) for d in docs]  # 0 end, 1 border
        self.size = np.array([len(d) for d in docs], np.int64)
        whole, skips, n = [], [], 0
        origin, skipped = [], []
        border = np.ones(1, np.int64)
        for d in self.docs:
            at = np.arange(n, n + len(d) + 1)
            whole += [d, border]
            origin.append(at)
            skips += [d[0::2], border, d[1::2], border]
            skipped += [at[:-1][0::2], at[-1:], at[:-1][1::2], at[-1:]]
            n += len(d) + 1
        self.text = np.concatenate(whole)
        self.origin = np.concatenate(origin + skipped)
        self.start = np.cumsum(self.size + 1) - (self.size + 1)
        self.doc = np.repeat(np.arange(len(docs)), self.size + 1)  # of a text position
        self.fm = FMIndex(np.concatenate(whole + skips), len(self.symbol) + 2)

    def leaks(self, items: _Items, min_words: int) -> dict[tuple[int, int], list[int]]:
        """(document, item) -> text positions of words in stretches of at least min_words words; every pair with such a stretch is there."""
        known = np.array([self.symbol.get(w, 0) for w in items.vocabulary], np.int64)
        there = (known[items.pairs] > 0).all(axis=1)
        lo, hi = np.zeros(len(items.pairs), np.int64), np.zeros(len(items.pairs), np.int64)
        lo[there], hi[there] = self.fm.search(known[items.pairs[there]])
        times = (hi - lo)[items.pair]
        cost = np.bincount(items.boundary, weights=times, minlength=len(items.codes))
        last = items.at == items.length[items.of] - 1  # no boundary follows the last word
        # The cheapest boundary of each group.
        order = np.lexsort((cost, last, items.group_of))
        first = order[np.flatnonzero(np.r_[True, np.diff(items.group_of[order]) > 0])]
        chosen = np.zeros(len(items.codes), bool)
        chosen[first[~last[first]]] = True
        use = np.flatnonzero(chosen[items.boundary] & (times > 0))
        out: dict[tuple[int, int], list[int]] = {}
        # By item, so many at a time as bounds the occurrences held.
        use = use[np.argsort(items.of[items.boundary[use]], kind="stable")]
        load = np.cumsum(times[use])
        item_of = items.of[items.boundary[use]]
        begin = 0
        while begin < len(use):
            done = load[begin - 1] if begin else 0
            end = max(int(np.searchsorted(load, done + HITS_AT_ONCE)), begin + 1)
            end = int(np.searchsorted(item_of, item_of[end - 1], side="right"))
            self._leaks_of(items, use[begin:end], lo, hi, min_words, known, out)
            begin = end
        return out

    def _leaks_of(self, items: _Items, use: np.ndarray, lo: np.ndarray, hi: np.ndarray, min_words: int, known: np.ndarray, out: dict) -> None:
        pairs, back = np.unique(items.pair[use], return_inverse=True)
        n = hi[pairs] - lo[pairs]
        first = np.cumsum(n) - n
        where = self.origin[self.fm.locate(np.arange(n.sum()) - np.repeat(first - lo[pairs], n))]
        k = n[back]
        of = np.repeat(np.arange(len(use)), k)
        where = where[np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k) + np.repeat(first[back], k)]
        boundary, place = items.boundary[use][of], items.place[use][of]
        item = items.of[boundary]
        doc = self.doc[where]
        # The same start may come from several pairs.
        _, once = np.unique(where * len(items.codes) + place, return_index=True)
        text = known[items.codes]
        # Of a stretch of min_words words half at least lie on one side of any of them: a short look both ways drops most of what is chance.
        few = min_words // 2
        for part in np.array_split(once, -(-len(once) // PLACES_AT_ONCE)):
            part = part[self._goes_on(text, where[part], place[part], few, 1) | self._goes_on(text, where[part], place[part], few, -1)]
            n_words = [self._reach(text, items, where[part], place[part], min_words, way) for way in (1, -1)]
            part = part[n_words[0] + n_words[1] > min_words]
            for q in part.tolist():
                out.setdefault((int(doc[q]), int(item[q])), []).append(int(where[q] - self.start[doc[q]]))

    def _goes_on(self, text: np.ndarray, where: np.ndarray, place: np.ndarray, links: int, way: int) -> np.ndarray:
        """Whether so many more words follow each place in the given direction; borders of items and documents are not seen, so some that do not are let through."""
        of, di, dj = np.arange(len(where)), np.zeros(len(where), np.int64), np.zeros(len(where), np.int64)
        width = 2 * links + 1
        for _ in range(links):
            nexts = []
            for a, b in MOVES:
                i, j = place[of] + way * (di + a), where[of] + way * (dj + b)
                inside = (i >= 0) & (i < len(text)) & (j >= 0) & (j < len(self.text))
                ok = np.flatnonzero(inside & (text.take(i, mode="clip") == self.text.take(j, mode="clip")))
                nexts.append((of[ok], di[ok] + a, dj[ok] + b))
            of, di, dj = (np.concatenate(x) for x in zip(*nexts))
            if len(of) > 4 * len(where):  # repeated words: many ways lead to one place
                key = np.unique((of * width + di) * width + dj)
                of, di, dj = key // width**2, key // width % width, key % width
        out = np.zeros(len(where), bool)
        out[of] = True
        return out

    def _reach(self, text: np.ndarray, items: _Items, where: np.ndarray, place: np.ndarray, most: int, way: int) -> np.ndarray:
        """Words of the longest stretch from each place (item word at text position) on, in the given direction, counted up to `most` and with the place itself."""
        reached = np.ones(len(where), np.int64)
        of = items.of[place]
        doc = self.doc[where]
        bounds = [items.start[of], items.start[of] + items.length[of], self.start[doc], self.start[doc] + self.size[doc]]
        # rows[-1][k, most + d]: words of the k-th stretch that ends with the item word now reached, d words off the diagonal.
        one, two = np.zeros((len(where), 2 * most + 1), np.int8), np.zeros((len(where), 2 * most + 1), np.int8)
        one[:, most] = 1
        drift = np.arange(-most, most + 1)
        alive = np.arange(len(where))
        for i in range(1, 2 * most - 1):
            at = place[alive] + way * i
            first, beyond, left, right = (b[alive] for b in bounds)
            word = np.where((at >= first) & (at < beyond), text[np.clip(at, 0, len(text) - 1)], 0)
            j = where[alive][:, None] + way * (i + drift)
            inside = (j >= left[:, None]) & (j < right[:, None]) & (word > 1)[:, None]
            come = np.maximum(one, two)  # all right; one altered
            np.maximum(come[:, 1:], one[:, :-1], out=come[:, 1:])  # one added
            np.maximum(come[:, :-1], two[:, 1:], out=come[:, :-1])  # one dropped
            same = inside & (come > 0) & (self.text[np.clip(j, 0, len(self.text) - 1)] == word[:, None])
            now = np.where(same, np.minimum(come + 1, most), 0).astype(np.int8)
            reached[alive] = np.maximum(reached[alive], now.max(axis=1, initial=0))
            go = one.any(axis=1) | now.any(axis=1)
            alive, two, one = alive[go], one[go], now[go]
            if not len(alive):
                break
        return reached


def _shard_leaks(blocks, shard: list[tuple[int, str, list[str]]], min_words: int, min_share: float, shard_words: int) -> list[tuple]:
    """The rows of leaked_items of some documents (id, text, words). blocks yields the items block by block."""
    # Pieces overlap by more than min_words words of a stretch can span.
    step = max(shard_words - 2 * min_words, 1)
    indexes, held, n = [], [], 0
    for k, (_, _, words) in enumerate(shard):
        for a in range(0, max(len(words) - 2 * min_words, 1), step):
            held.append((k, a))
            n += min(len(words), shard_words)
            if n >= shard_words:
                indexes, held, n = [*indexes, held], [], 0
    indexes += [held] if held else []
    found: dict[tuple[int, int, int], list[int]] = {}
    leaked: dict[tuple[int, int], tuple[int, list[str]]] = {}  # the items found
    margin = 0
    for part in indexes:
        index = _Shard([shard[k][2][a : a + shard_words] for k, a in part])
        for b, items in enumerate(blocks()):
            margin = 2 * (2 * items.group + 2)
            for (d, i), places in index.leaks(items, min_words).items():
                k, a = part[d]
                found.setdefault((k, b, i), []).extend(p + a for p in places)
                leaked[(b, i)] = items.ids[i], items.words[i]
    out = []
    places_of: dict[int, list[tuple[int, int]]] = {}
    for (k, b, i), at in sorted(found.items()):
        doc_id, text, words = shard[k]
        item_id, item = leaked[(b, i)]
        # A stretch has a place that was found in each whole group it crosses, so none of its words is further from such a
        # place than two groups are long, at two document words each.
        reach, spots = margin, sorted(set(at))
        doc: list[str | None] = []
        origin: list[int] = []
        to = 0
        for p in spots:
            a, z = max(p - reach, to), min(p + reach, len(words))
            if a >= z:
                continue
            if a > to and doc:
                doc += [None] * 3  # a gap that no move crosses
                origin += [-1] * 3
            doc += words[a:z]
            origin += range(a, z)
            to = z
        chain = aligned_stretches(item, doc, min_words)
        share = sum(e[0] for e in chain) / len(item)
        if share >= min_share - 1e-9:
            if k not in places_of:
                places_of = {k: word_places(text)}
            place = places_of[k]
            spans = [(origin[e[3]], origin[e[4] - 1] + 1) for e in chain]
            out.append((doc_id, item_id, share, spans, [(place[a][0], place[z - 1][1]) for a, z in spans]))
    return out


def leaked_items(
    documents: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id",
    min_words: int = 12, min_share: float = 1 / 3, shard_words: int = 400_000,
) -> DataFrame:
    """(doc_id, item_id, share, spans, places): documents that hold, in the item's order, stretches of at least min_words words of the item that together make up min_share of its words.

    spans are ranges [from, to) of the normalised document's words, places the
    same as ranges of characters of the text as it stands, to be removed. Case, punctuation, spacing, accents and Unicode form do not matter;
    single altered, added or dropped words do not end a stretch, at whatever
    spacing they come. Null, blank and wordless texts hold nothing; items
    shorter than min_words leak nowhere; repeated rows give the same rows, which
    come out once; empty tables give an empty result; other columns are ignored,
    whatever their names. Documents of more than shard_words words are indexed
    in overlapping pieces. The corpus is read and indexed once, for any number
    of items; these are collected and broadcast in blocks of at most
    ITEMS_PER_BLOCK, which the workers load one after the other.
    """
    if min_words < 2:
        raise ValueError("min_words must be at least 2")
    spark = documents.sparkSession
    n_items = items.count()
    rows = items.select(F.col(item_id).cast("long").alias("i"), F.col(text).alias("t")).where("i IS NOT NULL AND t IS NOT NULL").distinct()
    n_blocks = max(1, -(-n_items // ITEMS_PER_BLOCK))
    # Twice as many buckets as blocks: a block of hashed items stays near its bound.
    parts = [rows] if n_blocks == 1 else [rows.where(F.pmod(F.xxhash64("i"), F.lit(2 * n_blocks)) == b) for b in range(2 * n_blocks)]
    shared = [spark.sparkContext.broadcast([tuple(r) for r in part.orderBy("i").collect()]) for part in parts]
    kind = "doc_id long, item_id long, share double, spans array<struct<from: int, to: int>>, places array<struct<from: int, to: int>>"
    docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = [_Items(shared[0].value, min_words)] if len(shared) == 1 else None

        def blocks() -> Iterator[_Items]:
            for its in kept or (_Items(b.value, min_words) for b in shared):
                if len(its.ids):
                    yield its

        def frame(got: list[tuple]) -> pd.DataFrame:
            # Object columns throughout: an empty shard's columns have no type of their own.
            rows = [(d, i, share, *[[{"from": a, "to": z} for a, z in x] for x in ranges]) for d, i, share, *ranges in got]
            return pd.DataFrame(rows, columns=["doc_id", "item_id", "share", "spans", "places"], dtype=object)

        held: list[tuple[int, str, list[str]]] = []
        n = 0
        for f in frames:
            for i, t in zip(f["doc_id"].tolist(), f["text"].tolist()):
                w = words_of(t)
                if len(w) < min_words:
                    continue
                held.append((i, t, w))
                n += len(w) + 1
                if n >= shard_words:
                    yield frame(_shard_leaks(blocks, held, min_words, min_share, shard_words))
                    held, n = [], 0
        if held:
            yield frame(_shard_leaks(blocks, held, min_words, min_share, shard_words))

    return docs.mapInPandas(scan, kind).dropDuplicates(["doc_id", "item_id"])


def removal_spans(found: DataFrame) -> DataFrame:
    """(doc_id, n_items, spans, places): per document the merged ranges of words and of characters to remove."""
    kind = "array<struct<from: int, to: int>>"

    def merged(ranges: str) -> Column:
        def add(acc: Column, x: Column) -> Column:
            last = F.element_at(acc, -1)
            longer = F.struct(last["from"].alias("from"), F.greatest(last["to"], x["to"]).alias("to"))
            joined = F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(longer))
            return F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["to"] >= x["from"]), joined).otherwise(F.concat(acc, F.array(F.struct(x["from"].alias("from"), x["to"].alias("to")))))

        return F.aggregate(F.array_sort(F.array_distinct(F.flatten(ranges))), F.array().cast(kind), add).cast(kind)

    # A row per item that the document leaks.
    return found.groupBy("doc_id").agg(F.countDistinct("item_id").alias("n_items"), F.collect_set("spans").alias("s"), F.collect_set("places").alias("p")).select(
        "doc_id", "n_items", merged("s").alias("spans"), merged("p").alias("places")
    )
