"""Language identification: scripts narrow the candidates, a word model scores them, and a Viterbi
pass with a switching penalty labels the spans of mixed texts."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import GOLDEN, doc_texts, let_go, mix, slices, text_slices

#: labelled documents that a language is learned from, at most
TRAIN_DOCS = 2000
#: hashed character windows of a model: 2^16 for each language
BUCKETS = 1 << 16
#: longest character window, and log units that a change of language costs
ORDER, SWITCH = 4, 8.0
#: languages of a model, at most; more are an error, never dropped
LANGUAGES = 256
#: share of a text's letters in its main language below which ``keep_identified`` drops it
MIN_SCORE = 0.4

#: characters of texts that are labelled together, and cells of their scores, about; a longer text is labelled alone
LABEL_CHARS, LABEL_CELLS = 8_000_000, 10_000_000
#: words scored at once, and words a worker remembers
SCORE_WORDS, HELD_WORDS = 20_000, 400_000

_WORDS = re.compile(r"[^\W\d_]+")

#: first code points of script ranges and their names (fixed values); letters below U+0250 are Latin
_SCRIPTS = [(0, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"), (0x590, "hebrew"), (0x600, "arabic"),
            (0x780, "other"), (0x900, "indic"), (0xE00, "thai"), (0xE80, "other"), (0x10A0, "georgian"),
            (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
            (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"), (0x3100, "han"), (0xA4D0, "other"),
            (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han")]
_STARTS = np.array([s for s, _ in _SCRIPTS])


def script(word: str) -> str:
    """The script range of a word's first letter."""
    return _SCRIPTS[int(np.searchsorted(_STARTS, ord(word[0]), "right")) - 1][1]


def words_of(text: str) -> list[str]:
    """Runs of letters (Unicode category L) in lower case."""
    words = _WORDS.findall(text.lower())
    if text.isascii() or all(map(str.isalpha, words)):
        return words
    # number signs that are no digits, such as fractions and Roman numerals, part letters
    return [x for w in words for x in ([w] if w.isalpha() else "".join(c if c.isalpha() else " " for c in w).split())]


def windows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word number) of all 1- to ORDER-character windows of the words between end marks."""
    text = np.frombuffer("".join(f" {w} " for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.array([len(w) + 2 for w in words], np.int64)
    owner = np.repeat(np.arange(len(words)), size)
    out_h, out_w = [], []
    acc = np.zeros(len(text), np.uint64)
    for k in range(ORDER):
        acc = mix(acc[:len(text) - k] * GOLDEN + text[k:] + np.uint64(k))
        if k:
            inside = owner[:len(acc)] == owner[k:]
            out_h.append(acc[inside])
            out_w.append(owner[:len(acc)][inside])
        else:
            inside = text != 32
            out_h.append(acc[inside])
            out_w.append(owner[inside])
    return (np.concatenate(out_h) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate(out_w)


class Model:
    """Log probabilities of windows in each language, the scripts each was seen in, and priors."""

    def __init__(self, langs: list[str], counts: np.ndarray, scripts: dict[str, Counter], docs: dict[str, int]):
        self.langs = langs
        counts = counts.astype(np.float64) + 0.5
        logp = np.log(counts / counts.sum(axis=1, keepdims=True))
        # what a window says against the mean of all languages; bounded, as one window proves little
        self.table = np.clip(logp - logp.mean(axis=0), -4, 4).T.astype(np.float32)
        self.prior = int(np.argmax([docs[x] for x in langs]))
        total = {x: sum(scripts[x].values()) for x in langs}
        self.of_script = {s: np.array([scripts[x][s] > 1e-3 * total[x] for x in langs])
                          for s in {s for x in langs for s in scripts[x]}}

    def scores(self, words: list[str]) -> np.ndarray:
        """(words, languages): windows' evidence, damped for long words; -inf for languages that do not use the
        word's script (all of them are open where none does)."""
        h, w = windows(words)
        out = np.zeros((len(words), len(self.langs)), np.float32)
        for j in range(len(self.langs)):
            out[:, j] = np.bincount(w, self.table[h, j], minlength=len(words))
        kind = np.searchsorted(_STARTS, np.fromiter((ord(w[0]) for w in words), np.int64, len(words)), "right") - 1
        for x in np.unique(kind):
            uses = self.of_script.get(_SCRIPTS[x][1])
            if uses is None or not uses.any():
                out[kind == x] = 0
            elif not uses.all():
                out[np.ix_(kind == x, ~uses)] = -50
        return out


def viterbi(score: np.ndarray, lengths: list[int], switch: float) -> np.ndarray:
    """Best language of each word for texts laid end to end, all texts taking each step together."""
    n, k = score.shape
    lengths = np.asarray(lengths)
    start = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    live = np.searchsorted(-lengths[order], -np.arange(1, int(lengths.max(initial=0)) + 1), "right")
    jump = np.zeros(n, np.int16)          # where a path that changes at this word came from
    stay = np.ones((n, k), bool)
    best = np.zeros((len(lengths), k), np.float32)
    for t, m in enumerate(live):
        rows = start[order[:m]] + t
        b = best[:m]
        if t:
            top = b.argmax(axis=1)
            change = b[np.arange(m), top] - np.float32(switch)
            keep = b >= change[:, None]
            jump[rows], stay[rows] = top, keep
            best[:m] = np.where(keep, b, change[:, None]) + score[rows]
        else:
            best[:m] = score[rows]
    path = np.zeros(n, np.int16)
    now = best.argmax(axis=1)
    for t in range(len(live) - 1, -1, -1):
        m = live[t]
        rows = start[order[:m]] + t
        path[rows] = now[:m]
        now[:m] = np.where(stay[rows, now[:m]], now[:m], jump[rows])
    return path


def held_out(doc_id) -> F.Column:
    """Whether a document's language is kept from learning: crc32 of its doc_id in decimals, mod 4, is 2."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learn(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Model | None:
    """A model from text and lang of labelled documents that are not held out, of each language at most
    ``train_docs``, those whose texts have the least hashes. None without such documents. The driver gets the
    hashed window counts: BUCKETS x LANGUAGES numbers at most."""
    labelled = (docs.where("lang IS NOT NULL AND text IS NOT NULL").where(~held_out(F.col("doc_id")))
                .select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")))
    hashes = labelled.select("lang", F.xxhash64("text").alias("h")).groupBy("lang", "h").agg(F.count(F.lit(1)).alias("n"))
    found = hashes.groupBy("lang").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts")).limit(LANGUAGES + 1).collect()
    size = {r.lang: r.n for r in found}
    if len(size) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not size:
        return None
    # of the distinct texts' hashes those below a share of four times the need are enough; the exact choice is made among them
    share = F.create_map(*[x for r in found for x in (F.lit(r.lang), F.lit(min(1.0, 4 * train_docs / r.texts)))])
    near = labelled.withColumn("h", F.xxhash64("text")).where(
        F.pmod("h", F.lit(1 << 30)) < F.element_at(share, F.col("lang")) * (1 << 30))
    one = Window.partitionBy("lang").orderBy("h")
    sample = (near.select("lang", "h").distinct().withColumn("r", F.row_number().over(one))
              .where(F.col("r") <= train_docs).select("lang", "h"))
    chosen = near.dropDuplicates(["lang", "h"]).join(F.broadcast(sample), ["lang", "h"]).select("lang", "text")
    langs = sorted(size)

    def run(batches):
        counts, scripts, seen = {}, {}, Counter()
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = Counter(words_of(text))
                seen[lang] += 1
                if not words:
                    continue
                w = list(words)
                n = np.fromiter(words.values(), np.float64, len(w))
                h, of = windows(w)
                got = counts.setdefault(lang, np.zeros(BUCKETS))
                got += np.bincount(h, n[of], minlength=BUCKETS)
                sc = scripts.setdefault(lang, Counter())
                for x, c in words.items():
                    sc[script(x)] += c
        for lang, n in seen.items():
            sc = scripts.get(lang, {})
            got = counts.get(lang, np.zeros(BUCKETS))
            at = np.flatnonzero(got)
            yield pa.record_batch(
                [pa.array([lang] * (len(at) + len(sc) + 1)), pa.array([*map(int, at), *[-2] * len(sc), -1], pa.int64()),
                 pa.array([*[None] * len(at), *sc, None], pa.string()), pa.array([*got[at], *sc.values(), n], pa.float64())],
                ["lang", "bucket", "script", "n"])

    rows = (chosen.mapInArrow(run, "lang string, bucket long, script string, n double")
            .groupBy("lang", "bucket", "script").agg(F.sum("n").alias("n")).toPandas())
    counts = np.zeros((len(langs), BUCKETS))
    at = rows["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy()
    cell = (rows["bucket"] >= 0).to_numpy()
    counts[at[cell], rows["bucket"].to_numpy()[cell]] = rows["n"].to_numpy()[cell]
    scripts = {x: Counter() for x in langs}
    for r in rows[rows["bucket"] == -2].itertuples():
        scripts[r.lang][r.script] += r.n
    return Model(langs, counts, scripts, size)


class _Numbers(dict):
    """Numbers of words in the order of their first use; ``new`` holds those added since it was last emptied."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


def _forget(known: dict, k: int) -> None:
    """Empties ``known``, a worker's words: their numbers, and their scores and lengths in arrays that grow in place."""
    known["at"], known["n"] = _Numbers(), 0
    known["table"], known["size"] = np.zeros((SCORE_WORDS, k), np.float32), np.zeros(SCORE_WORDS, np.int32)


def _ids(model: Model, texts: list[str], known: dict) -> tuple[np.ndarray, list[int]]:
    """Numbers of the words of all texts, cut text by text, and how many each text has."""
    at, out = known["at"], []
    for text in texts:
        words = words_of(text)
        out.append(np.fromiter(map(at.__getitem__, words), np.int32, len(words)))
    while len(at) > len(known["size"]):
        for name in ("table", "size"):
            known[name] = np.concatenate((known[name], np.zeros_like(known[name])))
    for first in range(0, len(at.new), SCORE_WORDS):
        part = at.new[first:first + SCORE_WORDS]
        rows = slice(known["n"], known["n"] + len(part))
        known["table"][rows], known["size"][rows] = model.scores(part), [len(w) for w in part]
        known["n"] += len(part)
    at.new.clear()
    return np.concatenate(out) if out else np.zeros(0, np.int32), [len(x) for x in out]


def _label(model: Model, texts: list[str], known: dict, switch: float):
    """(language or None, share of letters in it, spans) of each text."""
    ids, lengths = _ids(model, texts, known)
    score = known["table"][ids]
    path = viterbi(score, lengths, switch)
    size = known["size"][ids]
    out, first = [], 0
    k = len(model.langs)
    for n in lengths:
        if not n:
            out.append((None, 0.0, []))
            continue
        p = path[first:first + n]
        chars = np.bincount(p, size[first:first + n], minlength=k)
        top = int(chars.argmax()) if score[first:first + n].any() else model.prior
        cuts = np.flatnonzero(np.diff(p)) + 1
        spans = [(int(a), int(b), model.langs[p[a]]) for a, b in zip([0, *cuts], [*cuts, n])]
        out.append((model.langs[top], float(chars[top] / chars.sum()), spans))
        first += n
    if known["n"] > HELD_WORDS:
        _forget(known, k)
    return out


def _label_chars(model: Model) -> int:
    """Characters of a slice: fewer with many languages, so that the scores of its words stay bounded (a word has some six letters)."""
    return min(LABEL_CHARS, 6 * LABEL_CELLS // max(1, len(model.langs)))


def identify(docs: DataFrame, train_docs: int = TRAIN_DOCS, switch: float = SWITCH) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, spans`` for every row of ``docs(doc_id, text, lang)``.

    ``spans`` lists the runs of words of one language as (first word, end word, lang), words being runs of
    letters; ``lang_pred`` is the language of most letters and ``score`` its share of them. A prediction
    reads the text alone. A text that is null or has no letter gets ``und``, score 0 and no spans;
    where no window of a text was ever seen with a language, the one with most labelled documents is
    predicted. Ties go to the language first in order. Without any labelled document all get ``und``.
    Repeated rows give repeated rows; empty tables give empty results; other columns are not read."""
    model = learn(docs, train_docs)
    schema = ("doc_id long, held_out boolean, lang_pred string, score double, "
              "spans array<struct<first:int,end:int,lang:string>>")
    if model is None:
        return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
                            F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
                .withColumn("spans", F.array().cast(schema.rpartition("spans ")[2])))
    held = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def run(batches):
        let_go()
        model, known = held.value, {}
        _forget(known, len(model.langs))
        for ids, texts in slices(batches, most=_label_chars(model)):
            got = _label(model, texts, known, switch)
            spans = [[{"first": a, "end": b, "lang": x} for a, b, x in s] for _, _, s in got]
            keep = [zlib.crc32(("" if i is None else str(i)).encode()) % 4 == 2 for i in ids]
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(keep), pa.array([g[0] or "und" for g in got]),
                                   pa.array([g[1] for g in got], pa.float64()), pa.array(spans, span)],
                                  ["doc_id", "held_out", "lang_pred", "score", "spans"])

    return doc_texts(docs).mapInArrow(run, schema)


def keep_identified(docs: DataFrame, min_score: float = MIN_SCORE, **options) -> DataFrame:
    """``docs`` without the rows whose language is ``und`` or holds less than ``min_score`` of the letters;
    all columns as they are, whatever their names. Each row is judged by its own text, so repeated rows stay or go
    together; null and empty texts go; an empty table gives an empty table. Without labelled documents no
    language is known and only texts without letters go."""
    model = learn(docs, **options)
    at = docs.columns.index("text")
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        let_go()
        model, known = held.value, {}
        if model is not None:
            _forget(known, len(model.langs))
        for part in text_slices(batches, at, LABEL_CHARS if model is None else _label_chars(model)):
            texts = [t or "" for t in part.column(at).to_pylist()]
            if model is None:
                keep = [bool(words_of(t)) for t in texts]
            else:
                keep = [g[0] is not None and g[1] >= min_score for g in _label(model, texts, known, SWITCH)]
            yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
