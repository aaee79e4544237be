"""Quality rules: counts of words, symbols and repetitions, and bands of character n-gram perplexity
under a modified Kneser-Ney model of each language, counted over all documents."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import GOLDEN, mix, text_slices

#: characters of the longest n-gram
ORDER = 4
#: rows and languages of a model that goes to the workers as arrays (about 100 MB); a larger one is joined with the words
MODEL_ROWS, LANGUAGES = 4_000_000, 256
#: a document's band is the median log perplexity of its language less and plus REACH spreads over the root of its
#: characters; the spread is the median absolute deviation times that root, LEAST_SPREAD at least
REACH, LEAST_SPREAD = 4.0, 0.3

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: white space of str.split that is not of the rule's
_OTHER_BLANK = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\v\f\r"
START, END = "\uffff", "\ufffe"


def words_of(text: str) -> list[str]:
    return _WORD.findall(text) if _OTHER_BLANK.search(text) else text.split()


def repeat_words(ids: np.ndarray) -> int:
    """Words in 3-word windows that occur twice or more."""
    if len(ids) < 4:
        return 0
    most = np.int64(ids.max()) + 1
    if most < 1 << 21:
        key = (ids[:-2] * most + ids[1:-1]) * most + ids[2:]
    else:
        _, pair = np.unique(ids[:-1] * most + ids[1:], return_inverse=True)
        key = pair[:-1] * most + ids[2:]
    ranked = np.sort(key)
    twice = ranked[1:][ranked[1:] == ranked[:-1]]
    if not len(twice):
        return 0
    hit = np.isin(key, twice)
    covered = np.zeros(len(ids), bool)
    for k in range(3):
        covered[k:len(ids) - 2 + k] |= hit
    return int(covered.sum())


def base_counts(text: str, words: list[str], ids: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    chars = len(text) - sum(text.count(c) for c in _BLANKS)
    symbols = sum(text.count(c) for c in _SYMBOLS)
    lines = text.split("\n")
    dup = 0
    if len(lines) > 1 and len(set(lines)) < len(lines):
        n = Counter(lines)
        dup = sum(c - 1 for line, c in n.items() if c > 1 and _WORD.search(line))
    return len(words), chars, symbols, dup, repeat_words(ids)


# --- the model -------------------------------------------------------------------

def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, each with ORDER - 1 start marks and an end mark, and the words' numbers."""
    pad = START * (ORDER - 1)
    text = "".join(f"{pad}{w}{END}" for w in words).encode("utf-32-le", "surrogatepass")
    size = np.fromiter(map(len, words), np.int64, len(words)) + ORDER
    return np.frombuffer(text, np.uint32), np.repeat(np.arange(len(words)), size)


def _counts(words: Counter) -> tuple[list[str], np.ndarray]:
    """All windows of ORDER characters with their counts."""
    code, owner = _codes(list(words))
    n = np.fromiter(words.values(), np.int64, len(words))
    inside = owner[:-ORDER + 1] == owner[ORDER - 1:]
    alphabet, at = np.unique(code, return_inverse=True)
    size = len(alphabet)
    if size ** ORDER >= 1 << 62:  # too many signs for one number: by halves
        half = [Counter(dict(list(words.items())[k::2])) for k in range(2)]
        parts = [_counts(h) for h in half if h]
        return [g for p in parts for g in p[0]], np.concatenate([p[1] for p in parts])
    key = np.zeros(len(code) - ORDER + 1, np.int64)
    for k in range(ORDER):
        key = key * size + at[k:len(code) - ORDER + 1 + k]
    cells, of = np.unique(key[inside], return_inverse=True)
    total = np.bincount(of, n[owner[:-ORDER + 1][inside]]).astype(np.int64)
    signs = np.empty((len(cells), ORDER), np.uint32)
    for k in range(ORDER - 1, -1, -1):
        signs[:, k] = alphabet[cells % size]
        cells = cells // size
    joined = signs.tobytes().decode("utf-32-le", "surrogatepass")
    return [joined[i:i + ORDER] for i in range(0, len(joined), ORDER)], total


def count_ngrams(docs: DataFrame) -> DataFrame:
    """``lang, gram, n``: windows of ORDER characters of the words of all documents ``(doc_id, text, lang)``.
    A task adds up its words first, and Spark the tasks' windows."""
    def run(batches):
        words: dict[str, Counter] = {}

        def flush():
            for lang, n in words.items():
                if n:
                    grams, total = _counts(n)
                    # a lone surrogate is no text to Spark: such windows are left to the backoff
                    ok = [i for i, g in enumerate(grams) if g.isascii() or not any("\ud800" <= c <= "\udfff" for c in g)]
                    yield pa.record_batch([pa.array([lang] * len(ok)), pa.array([grams[i] for i in ok]),
                                           pa.array(total[ok], pa.int64())], ["lang", "gram", "n"])
            words.clear()

        for _, texts, langs in _parts(batches):
            for text, lang in zip(texts, langs):
                words.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, words.values())) > 400_000:
                yield from flush()
        yield from flush()

    return (docs.mapInArrow(run, "lang string, gram string, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def kneser_ney(grams: DataFrame) -> DataFrame:
    """``lang, size, gram, own, n, left``: for each window of 1 to ORDER characters its discounted share of
    its context (``own``), and for each context the weight ``left`` to shorter ones. Below ORDER, counts
    are those of different characters before the window (continuations). The three discounts of each
    language and order come from its counts of counts."""
    out = None
    level = grams
    for size in range(ORDER, 0, -1):
        if size < ORDER:
            level = level.groupBy("lang", F.expr(f"substring(gram, 2, {size})").alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        level = materialize(level, "ngrams")
        if size == ORDER:
            few_langs = level.select("lang").distinct().limit(LANGUAGES + 1).count() <= LANGUAGES
        few = level.groupBy("lang").agg(*[F.count(F.when(F.col("n") == k, 1)).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)])
        y = F.col("n1") / F.greatest(F.col("n1") + 2 * F.col("n2"), F.lit(1.0))

        def discount(k):
            raw = k - (k + 1) * y * F.col(f"n{k + 1}") / F.greatest(F.col(f"n{k}"), F.lit(1.0))
            return F.least(F.greatest(raw, F.lit(0.1)), F.lit(k - 0.1)).alias(f"d{k}")

        few = few.select("lang", discount(1), discount(2), discount(3))
        prior = F.expr(f"substring(gram, 1, {size - 1})")
        cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        with_d = level.join(F.broadcast(few) if few_langs else few, "lang").withColumn("d", cut).withColumn("prior", prior)
        ctx = with_d.groupBy("lang", "prior").agg(F.sum("n").alias("total"), F.sum("d").alias("taken"))
        part = (with_d.join(ctx, ["lang", "prior"])
                .select("lang", F.lit(size).alias("size"), "gram", ((F.col("n") - F.col("d")) / F.col("total")).alias("own"),
                        "n", F.lit(None).cast("double").alias("left")))
        back = ctx.select("lang", F.lit(size - 1).alias("size"), F.col("prior").alias("gram"), F.lit(None).cast("double").alias("own"),
                          F.col("total").alias("n"), (F.col("taken") / F.col("total")).alias("left"))
        both = part.unionByName(back)
        out = both if out is None else out.unionByName(both)
    # one row per window
    return (out.groupBy("lang", "size", "gram")
            .agg(F.max("own").alias("own"), F.max("n").alias("n"), F.max("left").alias("left")))


def _held(rows: DataFrame) -> pd.DataFrame:
    """The rows of ``kneser_ney`` at the driver, strings side by side in Arrow's memory and not as objects."""
    return rows.select("lang", "size", "gram", "own", "left").toArrow().to_pandas(types_mapper=pd.ArrowDtype, self_destruct=True)


def _hash(code: np.ndarray, lang: int) -> np.ndarray:
    """Hashes of rows of code points."""
    acc = np.full(len(code), mix(np.array([lang + 1], np.uint64) * GOLDEN)[0])
    for k in range(code.shape[1]):
        acc = mix(acc * GOLDEN + code[:, k])
    return acc


class Model:
    """Log probabilities and back-off weights in arrays sorted by hash, per language and size."""

    def __init__(self, rows):
        langs = sorted(rows["lang"].unique())
        self.lang = {x: i for i, x in enumerate(langs)}
        self.keys, self.logp, self.left = {}, {}, {}
        for lang, i in self.lang.items():
            mine = rows[rows["lang"] == lang]
            self.floor = -np.log(max(2, int((mine["size"] == 1).sum()) + 1))
            for size in range(ORDER + 1):
                part = mine[mine["size"] == size]
                text = "".join(part["gram"]).encode("utf-32-le", "surrogatepass")
                code = np.frombuffer(text, np.uint32).reshape(len(part), size).astype(np.uint64)
                key = _hash(code, i)
                order = np.argsort(key, kind="stable")
                self.keys[i, size] = key[order]
                self.left[i, size] = part["left"].fillna(1.0).to_numpy(np.float64)[order]
                self.logp[i, size] = np.full(len(part), np.nan)
                if size:
                    # interpolated with the next shorter window, which is complete by now
                    lower = self.look(code[:, 1:], i, size - 1)
                    weight = self.weight(code[:, :-1], i, size - 1)
                    own = part["own"].fillna(0.0).to_numpy(np.float64)
                    self.logp[i, size] = np.where(part["own"].isna(), np.nan, np.log(own + weight * np.exp(lower)))[order]

    def _at(self, code: np.ndarray, lang: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        keys, h = self.keys[lang, size], _hash(code, lang)
        at = np.minimum(np.searchsorted(keys, h), max(0, len(keys) - 1))
        return at, (keys[at] == h) if len(keys) else np.zeros(len(h), bool)

    def weight(self, code: np.ndarray, lang: int, size: int) -> np.ndarray:
        at, found = self._at(code, lang, size)
        return np.where(found, self.left[lang, size][at] if len(self.left[lang, size]) else 1.0, 1.0)

    def look(self, code: np.ndarray, lang: int, size: int) -> np.ndarray:
        """Log probability of the last character after the ``size - 1`` before it."""
        if not size:
            return np.full(len(code), self.floor)
        at, found = self._at(code, lang, size)
        out = np.full(len(code), np.nan)
        if len(self.keys[lang, size]):
            out[found] = self.logp[lang, size][at[found]]
        miss = np.isnan(out)
        if miss.any():
            rest = code[miss]
            out[miss] = np.log(self.weight(rest[:, :-1], lang, size - 1)) + self.look(rest[:, 1:], lang, size - 1)
        return out

    def words(self, words: list[str], lang: int) -> np.ndarray:
        code, owner = _codes(words)
        inside = np.flatnonzero(owner[:-ORDER + 1] == owner[ORDER - 1:])
        win = np.stack([code[inside + k] for k in range(ORDER)], axis=1).astype(np.uint64)
        return np.bincount(owner[inside], self.look(win, lang, ORDER), minlength=len(words))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Base counts and log perplexity a character of each document (null without words)."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "log_ppl"]

    def run(batches):
        model = held.value
        known: dict[str, tuple[dict, np.ndarray]] = {}  # by language: numbers of words, and their log probabilities
        for ids, texts, langs in _parts(batches):
            words = [words_of(t) for t in texts]
            of_lang: dict[str, list] = {}
            for ws, lang in zip(words, langs):
                of_lang.setdefault(lang, []).append(ws)
            for lang, those in of_lang.items():
                number, logp = known.setdefault(lang, ({}, np.zeros(0)))
                new = list(set().union(*those).difference(number))
                if new:
                    number.update(zip(new, range(len(number), len(number) + len(new))))
                    known[lang] = number, np.concatenate((logp, model.words(new, model.lang[lang])))
            cols: list[list] = [[] for _ in range(6)]
            for t, ws, lang in zip(texts, words, langs):
                number, logp = known[lang]
                at = np.fromiter(map(number.__getitem__, ws), np.int64, len(ws))
                n = base_counts(t, ws, at)
                for c, v in zip(cols, (*n, -float(logp[at].sum()) / (n[1] + n[0]) if ws else None)):
                    c.append(v)
            if sum(len(n) for n, _ in known.values()) > 400_000:
                known.clear()
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(langs, pa.string()),
                                   *(pa.array(c, pa.int64()) for c in cols[:5]), pa.array(cols[5], pa.float64())], names)

    return docs.mapInArrow(run, "doc_id long, lang string, n_words long, word_chars long, n_symbols long, "
                                "n_dup_lines long, n_repeat_words long, log_ppl double")


def log_probabilities(rows: DataFrame) -> DataFrame:
    """``lang, gram, logp`` of all windows of ORDER characters, from the rows of ``kneser_ney``, by joins: a
    window's share plus its context's weight times the probability of the window without its first character."""
    least = rows.where("size = 1").groupBy("lang").agg((1 / F.greatest(F.count(F.lit(1)) + 1, F.lit(2))).alias("p"))
    below = least.select("lang", F.lit("").alias("gram"), "p")
    for size in range(1, ORDER + 1):
        own = (rows.where((F.col("size") == size) & F.col("own").isNotNull())
               .select("lang", "gram", "own", F.expr(f"substring(gram, 1, {size - 1})").alias("prior"),
                       F.expr(f"substring(gram, 2, {size - 1})").alias("rest")))
        weight = rows.where((F.col("size") == size - 1) & F.col("left").isNotNull()).select("lang", F.col("gram").alias("prior"), "left")
        below = materialize(own.join(weight, ["lang", "prior"]).join(below.withColumnRenamed("gram", "rest"), ["lang", "rest"])
                            .select("lang", "gram", (F.col("own") + F.col("left") * F.col("p")).alias("p")), "probabilities")
    return below.select("lang", "gram", F.log("p").alias("logp"))


def score_by_join(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``score`` for a model of any size: distinct words are cut into windows and meet the model by a join,
    and the words of each distinct text meet theirs (a frequent word's rows are a sorted side, which adaptive
    execution splits)."""
    schema = "doc_id long, lang string, h binary, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"

    def count(batches):
        for ids, texts, langs in _parts(batches):
            cols: list[list] = [[] for _ in range(5)]
            for t in texts:
                ws = words_of(t)
                number = {w: k for k, w in enumerate(set(ws))}
                for c, v in zip(cols, base_counts(t, ws, np.fromiter(map(number.__getitem__, ws), np.int64, len(ws)))):
                    c.append(v)
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(langs, pa.string()), pa.array(map(_digest, texts), pa.binary()),
                                   *(pa.array(c, pa.int64()) for c in cols)], [f.split()[0] for f in schema.split(", ")])

    def occur(batches):
        for _, texts, langs in _parts(batches):
            for t, lang in zip(texts, langs):
                n = Counter(words_of(t))
                yield pa.record_batch([pa.array([lang] * len(n), pa.string()), pa.array([_digest(t)] * len(n), pa.binary()),
                                       pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())],
                                      ["lang", "h", "word", "times"])

    def cut(batches):
        for batch in batches:
            langs, words, grams = [], [], []
            for lang, w in zip(*(c.to_pylist() for c in batch.columns)):
                t = START * (ORDER - 1) + w + END
                grams += [t[i:i + ORDER] for i in range(len(w) + 1)]
                langs += [lang] * (len(w) + 1)
                words += [w] * (len(w) + 1)
            yield pa.record_batch([pa.array(x, pa.string()) for x in (langs, words, grams)], ["lang", "word", "gram"])

    used = materialize(docs.mapInArrow(occur, "lang string, h binary, word string, times long")
                       .groupBy("lang", "h", "word").agg(F.max("times").alias("times")), "occurrences")
    grams = used.select("lang", "word").distinct().mapInArrow(cut, "lang string, word string, gram string")
    of_word = grams.join(log_probabilities(rows), ["lang", "gram"]).groupBy("lang", "word").agg(F.sum("logp").alias("logp"))
    of_text = (used.join(of_word, ["lang", "word"]).groupBy("lang", "h").agg(F.sum(F.col("times") * F.col("logp")).alias("logp")))
    return (docs.mapInArrow(count, schema).join(of_text, ["lang", "h"], "left")
            .withColumn("log_ppl", -F.col("logp") / (F.col("word_chars") + F.col("n_words"))).drop("h", "logp"))


def _parts(batches):
    for part in text_slices(batches, 1):
        yield tuple(c.to_pylist() for c in part.columns)


def _digest(text: str) -> bytes:
    return hashlib.md5(text.encode("utf-8", "surrogatepass")).digest()


def _medians(rows: DataFrame, value: str, steps: int) -> DataFrame:
    """``lang, median`` of a column in ``steps`` steps to one. Equal steps are added up before they are ordered, so an order
    runs over some thousand steps a language."""
    n = rows.groupBy("lang", F.round(F.col(value) * steps).cast("long").alias("step")).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("lang").orderBy("step")
    run = n.withColumn("upto", F.sum("n").over(order)).withColumn("all", F.sum("n").over(Window.partitionBy("lang")))
    return run.where(2 * F.col("upto") >= F.col("all")).groupBy("lang").agg((F.min("step") / steps).alias("median"))


def bands(scored: DataFrame, few_langs: bool = True) -> DataFrame:
    """``lang, middle, spread``: the median of log perplexity over all different documents of 50 words or more of a
    language, and the median absolute deviation from it, each deviation times the root of the document's
    characters (the mean of more characters strays less). Copies count once, so a large group of them
    moves neither."""
    rows = (scored.where("log_ppl IS NOT NULL AND n_words >= 50").select("lang", "n_words", "word_chars", "n_symbols", "log_ppl").distinct())
    middle = materialize(_medians(rows, "log_ppl", 1000).withColumnRenamed("median", "middle"), "bands")
    off = rows.join(F.broadcast(middle) if few_langs else middle, "lang").withColumn("off", F.abs(F.col("log_ppl") - F.col("middle")) * _root())
    spread = _medians(off, "off", 100).select("lang", F.greatest("median", F.lit(LEAST_SPREAD)).alias("spread"))
    return middle.join(spread, "lang")


def _root() -> F.Column:
    """The root of the characters that a document's perplexity is the mean of: those of its words, and their ends."""
    return F.sqrt((F.col("word_chars") + F.col("n_words")).cast("double"))


def quality(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    perplexity, lower, upper`` for every row of ``docs(doc_id, text, lang)``.

    Base rules are exact counts over the whole text. The model holds character windows of all words of all
    documents, a model for each ``lang`` (a null lang is a language of its own); up to MODEL_ROWS rows it is
    looked up in sorted hash arrays, beyond that it is joined, with the same results; perplexity is that of
    the words' characters and ends. A document is kept if it passes the base rules and its perplexity lies in
    its language's band for its length (see ``bands``), ends included; where no document has 50 words there is no band and no
    rejection by it. Null and empty texts have no words, fail the base rules and have no perplexity.
    Repeated rows give repeated rows and count as often; empty tables give empty results; other columns
    are not read."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"))
    rows = materialize(kneser_ney(count_ngrams(texts)), "model")
    few_langs = rows.select("lang").distinct().limit(LANGUAGES + 1).count() <= LANGUAGES
    in_arrays = few_langs and rows.count() <= MODEL_ROWS
    scored = materialize(score(texts, Model(_held(rows))) if in_arrays else score_by_join(texts, rows), "scored")
    limits = F.broadcast(bands(scored)) if few_langs else bands(scored, False)
    reach = REACH * F.col("spread") / _root()
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    within = F.col("log_ppl").between(F.col("lower"), F.col("upper"))
    return (scored.join(limits, "lang", "left").withColumn("base_failed", failed)
            .withColumns({"lower": F.when(F.col("n_words") > 0, F.col("middle") - reach), "upper": F.when(F.col("n_words") > 0, F.col("middle") + reach)})
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & F.coalesce(within, F.lit(True))).alias("kept"),
                    F.exp("log_ppl").alias("perplexity"), F.exp("lower").alias("lower"), F.exp("upper").alias("upper")))
