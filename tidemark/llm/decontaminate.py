"""Benchmark decontamination: a BM25 index of test items, queried by every training passage
under block-max upper bounds, then verified by word overlap of question and answer."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_texts, let_go, slices, text_slices

#: words between the starts of passages; a passage is twice as long, so every run of PASSAGE
#: words lies whole in one of them. Longer items are indexed as pieces of so many words.
PASSAGE = 64
#: share of an item's own score that a passage must reach to be retrieved
THRESHOLD = 0.5
#: share of the 5-word windows that must be found, and words of a question that count alone
OVERLAP, GRAM, LONE_QUESTION = 0.8, 5, 8
K1, B = 1.2, 0.75
BLOCK = 16
#: characters of items in one index; a larger benchmark is taken in blocks, each against all documents
INDEX_CHARS = 16_000_000
#: bytes of texts that query an index at once, and entries of its lists laid out at once, about
QUERY_CHARS, SPREAD = 1_000_000, 500_000

#: signs that stand for blanks (fixed values)
_SIGNS = ".,;:!?\"()[]{}<>|*#%&$~`“”«»…¿¡"


def terms(text: str) -> list[str]:
    """Words in lower case, cut at white space and at signs other than apostrophes and dashes."""
    text = text.lower()
    for c in _SIGNS:
        if c in text:
            text = text.replace(c, " ")
    return text.split()


def question_answer(text: str) -> tuple[list[str], list[str]]:
    """Terms of an item's question and answer: cut after the last question mark that words follow, else
    before the last sentence or line; an item of one sentence is all question."""
    cuts = [m.end() for m in re.finditer(r"\?|[.!](?=\s)|\n", text)]
    asked = [c for c in cuts if text[c - 1] == "?"]
    for c in reversed(asked or cuts):
        q, a = terms(text[:c]), terms(text[c:])
        if q and a:
            return q, a
    return terms(text), []


def grams(words: list[str]) -> set[tuple[str, ...]]:
    return {tuple(words[i:i + GRAM]) for i in range(max(1, len(words) - GRAM + 1))} if words else set()


class Index:
    """Impacts of terms in pieces of items, each as a share of the piece's own score, with their
    maxima per block of BLOCK pieces. Holds items of INDEX_CHARS characters at most.

    Beside the whole item, its question is cut into pieces of its own where it counts alone or is the greater part, and
    its answer where that is the greater part: whatever part a text holds of an item that it leaks, one of them tells."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = [i for i, _ in items]
        self.parts = [question_answer(t) for _, t in items]
        runs = [(k, q + a, True) for k, (q, a) in enumerate(self.parts) if q]
        for k, (q, a) in enumerate(self.parts):
            more = len(grams(a)) > len(grams(q))
            if a and (len(q) >= LONE_QUESTION or not more):
                runs.append((k, q, False))
            if more:
                runs.append((k, a, False))
        # a short tail says little: it is joined to no piece of its own unless the run has no other
        pieces = [(k, words[s:s + PASSAGE], whole) for k, words, whole in runs for s in range(0, len(words), PASSAGE)
                  if len(words) - s >= 16 or len(words) <= PASSAGE]
        pieces.sort(key=lambda p: len(p[1]))
        self.item = np.array([k for k, _, _ in pieces], np.int64)
        n, wholes = len(pieces), [w for _, w, whole in pieces if whole]
        mean = sum(map(len, wholes)) / max(1, len(wholes))
        posts: dict[str, list] = defaultdict(list)
        for e, (_, words, _) in enumerate(pieces):
            for t, tf in Counter(words).items():
                posts[t].append((e, tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean))))
        self.term_id = {t: i for i, t in enumerate(posts)}
        df = np.array([len(p) for p in posts.values()], np.float64)
        # parts on their own change no weight: terms are counted in whole items
        among = Counter(t for w in wholes for t in set(w))
        held = np.array([among[t] for t in posts], np.float64)
        idf = np.log(1 + (len(wholes) - held + 0.5) / (held + 0.5))
        self.ptr = np.concatenate(([0], np.cumsum(df))).astype(np.int64)
        self.post = np.array([e for p in posts.values() for e, _ in p], np.int64)
        impact = np.array([x for p in posts.values() for _, x in p]) * np.repeat(idf, df.astype(np.int64))
        self.impact = impact / np.bincount(self.post, impact, minlength=n)[self.post] if n else impact
        # frequent terms bound nothing well: together they are bounded by the most any piece has of them
        self.rare = df <= max(1, n / 8)
        of_term = np.repeat(np.arange(len(df)), df.astype(np.int64))
        common = ~self.rare[of_term]
        self.common_most = float(np.bincount(self.post[common], self.impact[common], minlength=max(n, 1)).max())
        self.blocks = -(-n // BLOCK)
        key = of_term * max(1, self.blocks) + self.post // BLOCK
        cells, at = np.unique(key, return_inverse=True)
        most = np.zeros(len(cells))
        np.maximum.at(most, at, self.impact)
        self.cell_block, self.cell_max = cells % max(1, self.blocks), most
        self.cell_ptr = np.searchsorted(cells // max(1, self.blocks), np.arange(len(df) + 1))
        self.ceiling = np.zeros(len(df))
        np.maximum.at(self.ceiling, of_term, self.impact)


def _spread(ptr: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all entries of the lists ``t``, and for each the index into ``t``."""
    size = ptr[t + 1] - ptr[t]
    owner = np.repeat(np.arange(len(t)), size)
    return np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(ptr[t], size), owner


def _runs(ptr: np.ndarray, win: np.ndarray, t: np.ndarray, step: int):
    """Slices of the sorted ``win``, whose lists ``t`` have about ``step`` entries together; a passage stays in one."""
    heavy = np.cumsum(ptr[t + 1] - ptr[t])
    last = 0
    for c in np.searchsorted(heavy, np.arange(step, (int(heavy[-1]) if len(heavy) else 0) + step, step)):
        c = min(c + 1, len(win))
        while c < len(win) and win[c] == win[c - 1]:
            c += 1
        if c > last:
            yield slice(last, c)
            last = c


def _distinct(key: np.ndarray) -> np.ndarray:
    key = np.sort(key)
    return key[np.concatenate(([True], key[1:] != key[:-1]))] if len(key) else key


def _sums(key: np.ndarray, weight: np.ndarray, least: float, space: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys below ``space`` whose weights add up to ``least`` or more, and their sums."""
    if space <= 1 << 22:
        total = np.bincount(key, weight, minlength=space)
        keys = np.flatnonzero(total >= least - 1e-9)
        return keys, total[keys]
    keys, at = np.unique(key, return_inverse=True)
    total = np.bincount(at, weight, minlength=len(keys))
    on = total >= least - 1e-9
    return keys[on], total[on]


def retrieve(index: Index, docs: list[np.ndarray], threshold: float) -> list[tuple[int, int, int, float]]:
    """(document, passage, piece, score) of all passages that score ``threshold`` or more; documents
    are arrays of term ids, -1 for terms outside the index."""
    if not index.blocks:
        return []
    passages = [max(1, -(-len(d) // PASSAGE)) for d in docs]
    base = np.cumsum([0, *passages])
    vocab = len(index.ceiling)
    where = np.concatenate([base[i] + np.arange(len(d)) // PASSAGE for i, d in enumerate(docs)])
    first = np.concatenate([np.arange(len(d)) < PASSAGE for d in docs])
    word = np.concatenate(docs)
    known = word >= 0
    where, first, word = where[known], first[known], word[known]
    n = int(base[-1])

    def in_passages(where, first, word):
        """Distinct (passage, term): a word is in the passage that starts at its step and in the one before."""
        key = where * vocab + word
        key = _distinct(np.concatenate((key, key[~first] - vocab)))
        return key // vocab, key % vocab

    # 1: no piece can reach the threshold if the ceilings of a passage's rare terms and the bound on the others do not
    rare = index.rare[word]
    win, term = in_passages(where[rare], first[rare], word[rare])
    alive = np.bincount(win, index.ceiling[term], minlength=n) + index.common_most >= threshold
    on = alive[win]
    win, term = win[on], term[on]
    # 2: the same for each block of pieces
    left = threshold - index.common_most
    if left <= 0:
        pairs = (np.flatnonzero(alive)[:, None] * index.blocks + np.arange(index.blocks)).ravel()
    else:
        found = [np.zeros(0, np.int64)]
        for run in _runs(index.cell_ptr, win, term, SPREAD):
            cell, owner = _spread(index.cell_ptr, term[run])
            found.append(_sums(win[run][owner] * index.blocks + index.cell_block[cell], index.cell_max[cell], left, n * index.blocks)[0])
        pairs = np.concatenate(found)
    if not len(pairs):
        return []
    # 3: scores of the pieces of the blocks that are left
    left = np.zeros(n, bool)
    left[pairs // index.blocks] = True
    on = left[where] | left[np.maximum(where - 1, 0)]
    win, word = in_passages(where[on], first[on], word[on])
    on = left[win]
    win, word = win[on], word[on]
    out = []
    for run in _runs(index.ptr, win, word, SPREAD):
        e, owner = _spread(index.ptr, word[run])
        w = win[run][owner]
        hit = np.isin(w * index.blocks + index.post[e] // BLOCK, pairs)
        cells, score = _sums(w[hit] * len(index.item) + index.post[e[hit]], index.impact[e[hit]], threshold, n * len(index.item))
        for x, s in zip(cells, score):
            p = int(x // len(index.item))
            d = int(np.searchsorted(base, p, "right")) - 1
            out.append((d, p - int(base[d]), int(x % len(index.item)), float(s)))
    return out


def _leaks(index: Index, texts: list[str], threshold: float, overlap: float):
    """For each text its leaks: {item: (score, question overlap, answer overlap)}."""
    words = [terms(t) for t in texts]
    found: list[dict] = [{} for _ in texts]
    number = index.term_id.get
    docs = [np.fromiter(map(number, w, repeat(-1)), np.int64, len(w)) for w in words]
    best: dict[tuple[int, int], list] = defaultdict(list)
    for d, p, e, s in retrieve(index, docs, threshold) if any(map(len, docs)) else []:
        best[d, int(index.item[e])].append((s, p))
    for (d, k), hits in best.items():
        q, a = index.parts[k]
        need, ask, answer = len(q) + len(a), grams(q), grams(a)
        got: list[float] = [0.0, 0.0]
        for s, p in sorted(hits, reverse=True):
            # the passage, and on both sides as much text as the item has
            near = words[d][max(0, p * PASSAGE - need):(p + 2) * PASSAGE + need]
            g = {z: {tuple(near[i:i + z]) for i in range(len(near) - z + 1)}
                 for z in {GRAM, min(GRAM, len(q)), min(GRAM, len(a) or GRAM)}}
            hit_q = sum(x in g[len(x)] for x in ask) / len(ask)
            hit_a = sum(x in g[len(x)] for x in answer) / len(answer) if answer else hit_q
            got = max(got, [hit_q, hit_a])
        whole = (got[0] * len(ask) + (got[1] * len(answer) if answer else 0)) / (len(ask) + len(answer))
        if got[0] >= overlap and (len(q) >= LONE_QUESTION or whole >= overlap) or whole >= overlap:
            found[d][index.ids[k]] = (max(s for s, _ in hits), got[0], got[1])
    return found


def indexes(benchmark: DataFrame):
    """Indexes of the items of ``benchmark(item_id, text)``, repeated rows once, null and empty texts
    left out, items without an id kept, each of INDEX_CHARS characters or so at most."""
    items = (benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text"))
             .where("length(trim(text)) > 0").distinct())
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-chars // INDEX_CHARS)
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        rows = sorted(((r.item_id, r.text) for r in part.toLocalIterator()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        if rows:
            yield Index(rows)


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
                 overlap: float = OVERLAP) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap, leak`` for every document that
    holds a test item.

    Each document is cut into passages of 2 x PASSAGE words at steps of PASSAGE, all of it; each
    passage queries the index with its distinct terms and retrieves every piece (of an item, its question or
    its answer) whose BM25 score is at least ``threshold`` of the piece's score against itself. Blocks whose maxima cannot reach that are not
    scored. A retrieved item is verified by the 5-word windows of its question and answer around the
    passage: it is a leak if ``overlap`` of the question's windows are there (a question of less
    than 8 words only together with the answer) or that share of all windows; ``leak`` is
    ``question and answer`` if the answer's share reaches ``overlap`` too, else ``question``.
    Score and overlaps are the greatest of the document.

    Null and empty texts have no row, nor do items without text; items with a null item_id count like others, in one row
    a document with item_id null; an item of fewer than five words is one window. Repeated document rows give repeated rows, repeated items none. Empty tables
    give an empty result. Extra columns are not read."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, leak string"
    out = spark.createDataFrame([], schema)
    texts = doc_texts(docs)
    for index in indexes(benchmark):
        held = spark.sparkContext.broadcast(index)

        def run(batches, held=held):
            let_go()
            index = held.value
            for ids, part in slices(batches, most=QUERY_CHARS):
                rows = [(i, k, *x, "question and answer" if x[2] >= overlap else "question")
                        for i, f in zip(ids, _leaks(index, part, threshold, overlap)) for k, x in f.items()]
                cols = list(zip(*rows)) if rows else [[]] * 6
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.string()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)],
                                      ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "leak"])

        out = out.union(texts.mapInArrow(run, schema))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
                      overlap: float = OVERLAP) -> DataFrame:
    """``docs`` without the rows that hold a test item (see ``contaminated``), all columns as they are.
    Each row is judged by its own text, whatever its doc_id, so repeated rows stay or go together; rows with a null
    or empty text stay; an empty table stays empty, an empty benchmark drops nothing."""
    at = docs.columns.index("text")
    for index in indexes(benchmark):
        held = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, held=held):
            let_go()
            index = held.value
            for part in text_slices(batches, at, QUERY_CHARS):
                texts = [t or "" for t in part.column(at).to_pylist()]
                found = _leaks(index, texts, threshold, overlap)
                part = part.filter(pa.array([not f for f in found], pa.bool_()))
                yield part

        docs = docs.mapInArrow(run, docs.schema)
    return docs
