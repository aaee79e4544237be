"""Personal data: base patterns, and weakly supervised spans beside them. Labelers vote on candidate
spans, expectation-maximisation estimates how far each can be trusted, and a span classifier is
trained on the resulting probabilities."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_texts, let_go, slices, text_slices

KINDS = ("email", "ip", "card", "phone", "secret")
BASE = KINDS[:4]

# --- base patterns (fixed by the query's contract) ---------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a match starts where a run of digits does: no run is tried again from its middle
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")


def _emails(text: str):
    """Matches of the email pattern, found from each @ on: what is left of it is the run of local characters."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d)
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as in KINDS and then by start."""
    out = [("email", s, e) for s, e in _emails(text)]
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(d := p.lstrip("0")) < 4 and int(d or 0) < 256 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and _luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return out


# --- candidates and labelers -------------------------------------------------

#: looser shapes per kind; a text is searched where the hint, which every match of the shape implies, is found in it
_LOOSE = [
    ("email", re.compile(r"[(\[](?:at|AT)[)\]]"), re.compile(r"\b[\w.+-]+ ?[(\[](?:at|AT)[)\]] ?[\w-]+(?: ?[(\[](?:dot|DOT)[)\]] ?[\w-]+|\.[\w-]+)+")),
    ("email", "[", re.compile(r"\b[\w.+-]+ ?\[(?:at|AT)\] ?[\w-]+(?: ?\[(?:dot|DOT)\] ?[\w-]+|\.[\w-]+)+")),
    ("ip", ":", re.compile(r"(?<![\w:])(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}(?![\w:])")),
    ("phone", re.compile(r"[0-9][ .-][0-9]{3}"), re.compile(r"(?<![\w+.-])(?:\([0-9]{2,4}\) ?)?[0-9]{2,4}[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![\w.-]?[0-9])")),
    ("phone", ")", re.compile(r"(?<![\w+.-])\([0-9]{2,4}\) ?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![\w.-]?[0-9])")),
    ("secret", "AKIA", re.compile(r"\bAKIA[0-9A-Z]{16}\b")),
    ("secret", "=", re.compile(r"\b[A-Za-z_]{2,20} ?= ?\"?[A-Za-z0-9_/+-]{12,}\"?")),
    ("secret", "-----", re.compile(r"-----BEGIN [A-Z ]+KEY-----")),
]

#: what stands between the parts of a spelled-out address, and its rest from there on (for the first two shapes above)
_AT = [re.compile(r"[(\[](?:at|AT)[)\]]"), re.compile(r"\[(?:at|AT)\]")]
_REST = [re.compile(r" ?[\w-]++(?: ?[(\[](?:dot|DOT)[)\]] ?[\w-]++|\.[\w-]++)++"), re.compile(r" ?[\w-]++(?: ?\[(?:dot|DOT)\] ?[\w-]++|\.[\w-]++)++")]


def _wordy(c: str) -> bool:
    return c.isalnum() or c == "_"


def _spelled(text: str, j: int):
    """Matches of shape j of _LOOSE, found from each spelled-out @ on, as ``_emails`` does: the run before it is read once."""
    last = 0
    for m in _AT[j].finditer(text):
        if m.start() <= last:
            continue
        end = m.start() - (text[m.start() - 1] == " ")
        start = end
        while start > last and (_wordy(text[start - 1]) or text[start - 1] in ".+-"):
            start -= 1
        while start < end and _wordy(text[start]) == (start > 0 and _wordy(text[start - 1])):  # a word's edge
            start += 1
        rest = _REST[j].match(text, m.end()) if start < end else None
        if rest:
            yield start, rest.end()
            last = rest.end()


# gazetteers and cues (fixed values)
_SUFFIXES = frozenset((
    "com org net edu gov mil int info biz name pro io ai app dev cloud online site shop store blog tech me tv co eu "
    "ae ar at au be bg br ca ch cl cn cz de dk ee eg es fi fr gr hk hr hu id ie il in ir is it jp ke kr lt lu lv ma mx my ng nl no nz "
    "pe ph pk pl pt ro rs ru sa se sg si sk th tn tr tw ua uk us uy ve vn za").split())
#: issuers: first and last prefix, and the lengths of their numbers
_ISSUERS = (
    ("34", "34", (15,)), ("37", "37", (15,)), ("4", "4", (13, 16, 19)), ("51", "55", (16,)), ("2221", "2720", (16,)),
    ("6011", "6011", (16, 17, 18, 19)), ("644", "649", (16, 17, 18, 19)), ("65", "65", (16, 17, 18, 19)),
    ("300", "305", (14, 16, 17, 18, 19)), ("36", "36", (14, 16, 17, 18, 19)), ("38", "39", (14, 16, 17, 18, 19)),
    ("3528", "3589", (16, 17, 18, 19)), ("62", "62", (16, 17, 18, 19)), ("50", "50", (13, 14, 15, 16, 17, 18, 19)),
    ("56", "58", (13, 14, 15, 16, 17, 18, 19)), ("6304", "6304", (16, 18, 19)), ("6759", "6763", (16, 18, 19)), ("2200", "2204", (16, 17, 18, 19)))
#: country codes, and the least and most digits of a number in that country
_DIAL = {
    "1": (10, 10), "7": (10, 10), "20": (8, 10), "27": (9, 9), "30": (10, 10), "31": (9, 9), "32": (8, 9), "33": (9, 9), "34": (9, 9),
    "36": (8, 9), "39": (6, 11), "40": (9, 9), "41": (9, 9), "43": (4, 13), "44": (9, 10), "45": (8, 8), "46": (7, 13), "47": (5, 8),
    "48": (9, 9), "49": (6, 13), "51": (8, 9), "52": (10, 10), "53": (6, 8), "54": (10, 11), "55": (10, 11), "56": (9, 9), "57": (10, 10),
    "58": (10, 10), "60": (7, 10), "61": (9, 9), "62": (7, 12), "63": (10, 10), "64": (8, 10), "65": (8, 8), "66": (8, 9), "81": (9, 10),
    "82": (8, 10), "84": (9, 10), "86": (10, 11), "90": (10, 10), "91": (10, 10), "92": (9, 10), "93": (9, 9), "94": (9, 9), "98": (10, 10),
    "212": (9, 9), "213": (8, 9), "216": (8, 8), "234": (7, 10), "254": (9, 10), "351": (9, 9), "352": (5, 11), "353": (7, 9), "354": (7, 9),
    "358": (5, 12), "359": (7, 9), "370": (8, 8), "371": (8, 8), "372": (7, 8), "380": (9, 9), "381": (8, 9), "385": (8, 9), "386": (8, 8),
    "420": (9, 9), "421": (9, 9), "852": (8, 8), "886": (8, 9), "966": (9, 9), "971": (8, 9), "972": (8, 9)}
#: what credentials are assigned to, and how known keys begin
_KEYS = ("password", "passwd", "passwort", "pwd", "pass", "secret", "token", "api_key", "apikey", "access_key", "accesskey", "auth",
         "private_key", "client_secret", "credential", "session", "bearer", "key", "contrasena", "mot_de_passe")
_KEY_HEADS = ("AKIA", "ASIA", "ghp_", "gho_", "sk_live", "sk_test", "xoxb", "xoxp", "AIza", "-----BEGIN")
#: given names that stand in the local part of an address
_GIVEN = frozenset((
    "alex alice ana andrea anna anne antonio barbara carlos charles chris claire claudia daniel david elena emily emma eric eva felix "
    "frank george hans helen henry ivan jack james jan jean jennifer john jorge jose juan julia karl kate kevin klaus laura linda lisa louis "
    "lucas luis maria marie mark martin mary matthias michael miguel monika nicolas nina olga oliver pablo patricia paul pedro peter "
    "philippe pierre rachel robert sandra sarah simon sofia stefan steven susan thomas tom ursula wolfgang").split())
_CUES = {
    "email": ("mail", "contact", "write", "correo", "courriel", "schreib"),
    "ip": ("ip", "host", "server", "address", "addr"),
    "card": ("card", "visa", "credit", "carte", "karte", "tarjeta"),
    "phone": ("phone", "call", "tel", "fax", "mobile", "telefon", "anruf"),
    "secret": ("password", "token", "secret", "login", "credential", "key", "access"),
}


def _known(kind: str, span: str) -> bool:
    """Whether the gazetteers know a span: a suffix, an issuer's range and length, a country's dial plan, an address block, a credential's name."""
    low, digits = span.lower(), _NOT_DIGIT.sub("", span)
    if kind == "email":
        return re.split(r"[\W_]+", low.rstrip(")]"))[-1] in _SUFFIXES
    if kind == "card":
        return any(first <= digits[:len(first)] <= last and len(digits) in sizes for first, last, sizes in _ISSUERS)
    if kind == "phone":
        if span.startswith("+"):
            return any(low <= len(digits) - n <= high for n in (1, 2, 3) for low, high in [_DIAL.get(digits[:n], (99, 0))])
        return len(digits) == 10 and digits[0] > "1" and digits[3] > "1"
    if kind == "ip":
        head = int(low.partition(":")[0], 16) if ":" in low else -1
        return 0x2000 <= head <= 0x3fff or 0xfc00 <= head <= 0xfdff or 0xfe80 <= head <= 0xfebf
    return span.startswith(_KEY_HEADS) or low.partition("=")[0].strip().endswith(_KEYS)


LABELERS = ("pattern", "gazetteer", "context", "shape", "neighbour")


def votes(kind: str, span: str, before: str, is_base: bool, near: bool) -> tuple[int, ...]:
    """A vote per labeler: 1 for personal data, -1 against, 0 for none."""
    alnum, named = [c for c in span if c.isalnum()], _known(kind, span)
    digits, variety = sum(c.isdigit() for c in span), len(set(alnum))
    if kind == "email":
        shape = 1 if variety >= 6 else -1
    elif kind == "ip":
        shape = 1 if variety >= 3 else -1
    elif kind == "card":
        shape = 1 if variety >= 4 else -1
    elif kind == "phone":
        shape = 1 if 9 <= digits <= 15 and variety >= 3 else -1
    else:
        shape = 1 if digits >= 4 and variety >= 8 else -1
    strict = is_base or kind == "secret" and (span.startswith(("AKIA", "-----BEGIN")) or digits >= 4 and "=" in span)
    cue = any(c in before.lower() for c in _CUES[kind])
    if kind == "email":
        cue = cue or any(part in _GIVEN for part in re.split(r"[\W_0-9]+", span.lower())[:2])
    return (1 if strict else -1, 1 if named else 0 if is_base else -1, 1 if cue else 0, shape, 1 if near else 0)


def candidates(text: str) -> tuple[list, list]:
    """(base spans, [(kind, start, end, is_base, features)]): base spans and loose spans that touch none."""
    base = base_spans(text)
    spans = [(s, e, k, True) for k, s, e in base]
    for j, (kind, hint, loose) in enumerate(_LOOSE):
        if hint in text if isinstance(hint, str) else hint.search(text):
            found = _spelled(text, j) if j < len(_AT) else (m.span() for m in loose.finditer(text))
            spans += [(s, e, kind, False) for s, e in found]
    if not spans:
        return base, []
    spans.sort(key=lambda x: (not x[3], x[0], -x[1]))
    taken, out = sorted((s, e) for s, e, _, b in spans if b), []
    starts, upto, most = [s for s, _ in taken], [], 0
    for _, e in taken:
        upto.append(most := max(most, e))
    free = 0  # where the last loose span that was taken ends
    for s, e, k, b in spans:
        before = bisect_left(starts, e)
        if b or s >= free and not (before and upto[before - 1] > s):
            if not b:
                free = e
            out.append((s, e, k, b))
    out.sort()
    rows = []
    for i, (s, e, k, b) in enumerate(out):
        near = i and s - out[i - 1][1] < 80 or i + 1 < len(out) and out[i + 1][0] - e < 80
        span = text[s:e]
        v = votes(k, span, text[max(0, s - 24):s], b, bool(near))
        size = min(4, (e - s) // 8)
        share = 4 * sum(c.isdigit() for c in span) // (e - s)
        rows.append((k, s, e, b, (KINDS.index(k), *v, size, min(3, share))))
    return base, rows


# --- estimation ----------------------------------------------------------------

def reliabilities(patterns: dict[tuple[int, ...], float], rounds: int = 50) -> tuple[dict, np.ndarray, float]:
    """Expectation-maximisation over counted vote patterns: the probability of each pattern to be personal
    data, each labeler's table of votes given the truth, and the prior. Starts from the majority."""
    keys = sorted(patterns)
    v = np.array(keys, np.int64)
    n = np.array([patterns[k] for k in keys], np.float64)
    p = 1 / (1 + np.exp(-2.0 * v.sum(axis=1)))
    for _ in range(rounds):
        prior = float(np.clip((n * p).sum() / n.sum(), 1e-3, 1 - 1e-3))
        table = np.stack([[[((n * w)[v[:, j] == x].sum() + 1) / ((n * w).sum() + 3) for x in (-1, 0, 1)]
                           for w in (1 - p, p)] for j in range(v.shape[1])])
        like = [np.log(1 - prior if t == 0 else prior) + sum(np.log(table[j, t, v[:, j] + 1]) for j in range(v.shape[1]))
                for t in (0, 1)]
        p = 1 / (1 + np.exp(np.clip(like[0] - like[1], -50, 50)))
    return dict(zip(keys, p)), table, prior


def _design(keys: list[tuple[int, ...]]) -> np.ndarray:
    """One-hot columns: bias, kind, each labeler's vote, size and digit classes."""
    sizes = (len(KINDS), *[3] * len(LABELERS), 5, 4)
    out = np.zeros((len(keys), 1 + sum(sizes)))
    out[:, 0] = 1
    at = 1
    for j, width in enumerate(sizes):
        col = np.array([k[j] for k in keys]) + (1 if 1 <= j <= len(LABELERS) else 0)
        out[np.arange(len(keys)), at + col] = 1
        at += width
    return out


def train_spans(counts: dict[tuple[int, ...], int]) -> np.ndarray | None:
    """Weights of a logistic regression over span features, fitted to the probabilities that the
    labelers' reliabilities give; ``counts`` holds how often each feature tuple occurs. None without spans."""
    if not counts:
        return None
    patterns: Counter = Counter()
    for k, c in counts.items():
        patterns[k[1:1 + len(LABELERS)]] += c
    p, _, _ = reliabilities(patterns)
    keys = sorted(counts)
    x = _design(keys)
    y = np.array([p[k[1:1 + len(LABELERS)]] for k in keys])
    n = np.array([counts[k] for k in keys], np.float64)
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w)) * 0.1
    for _ in range(25):  # Newton steps
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= np.linalg.solve((x * (n * q * (1 - q))[:, None]).T @ x + ridge, x.T @ (n * (q - y)) + ridge @ w)
    return w


def fit(docs: DataFrame) -> np.ndarray | None:
    """Span classifier from the votes on all candidates of all documents. What reaches the driver is a
    count per feature tuple: at most 5 kinds x 3^5 votes x 20 classes = 24,300 rows."""
    schema = "features array<int>, n long"

    def run(batches):
        let_go()
        n: Counter = Counter()
        for _, texts in slices(batches):
            for t in texts:
                n.update(r[4] for r in candidates(t)[1])
        yield pa.record_batch([pa.array([list(k) for k in n], pa.list_(pa.int32())),
                               pa.array(list(n.values()), pa.int64())], ["features", "n"])

    rows = doc_texts(docs).mapInArrow(run, schema).groupBy("features").agg(F.sum("n").alias("n")).collect()
    return train_spans({tuple(r.features): r.n for r in rows})


def _chances(weights: np.ndarray):
    memo: dict = {}

    def of(features: tuple[int, ...]) -> float:
        if features not in memo:
            memo[features] = float(1 / (1 + np.exp(-(_design([features]) @ weights)[0])))
        return memo[features]
    return of


def all_spans(text: str, chance, threshold: float) -> tuple[list, list]:
    """(base spans, all spans), both by kind and start: base ones stay, and of the others those that the
    classifier gives ``threshold`` or more."""
    base, rows = candidates(text)
    more = [(k, s, e) for k, s, e, b, f in rows if not b and chance is not None and chance(f) >= threshold]
    return base, sorted(base + more, key=lambda x: (KINDS.index(x[0]), x[1])) if more else base


def _digest(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added, n_spans`` for every row of ``docs``.

    Base spans follow the four patterns, leftmost and without overlap in a kind, over the whole text.
    Loose candidates (spelled-out addresses, numbers without a country, long IP
    addresses, credentials as kind ``secret``) and base spans get votes from five labelers: pattern,
    gazetteer, context, shape, neighbourhood. Their reliabilities come from expectation-maximisation
    over all votes of the corpus, and a logistic regression on the resulting probabilities decides on the loose
    ones; none that touches a base span is added. Kinds are ordered as in KINDS.

    Null and empty texts have no spans (the digest is that of the empty string). Repeated rows give
    repeated rows, an empty table gives an empty result; other columns are not read. The classifier is
    fitted here, so results follow the input."""
    weights = fit(docs)
    schema = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
              "spans string, n_added long, n_spans long")

    def run(batches):
        let_go()
        chance = _chances(weights) if weights is not None else None
        for ids, texts in slices(batches):
            cols: list[list] = [[] for _ in range(8)]
            for t in texts:
                base, spans = all_spans(t, chance, threshold)
                n = Counter(k for k, _, _ in base)
                for c, v in zip(cols, (*(n[k] for k in BASE), hashlib.sha256(_digest(base).encode()).hexdigest(),
                                       _digest(spans), len(spans) - len(base), len(spans))):
                    c.append(v)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()] * 2
            yield pa.record_batch([pa.array(ids, pa.int64()), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                                  [f.split()[0] for f in schema.split(", ")])

    return doc_texts(docs).mapInArrow(run, schema)


def mask(text: str, spans) -> str:
    """Spans give way to [KIND]; overlapping spans become one, named by the first."""
    out, last = [], 0
    for k, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= last:
            out += [text[last:s], f"[{k.upper()}]"]
        last = max(last, e)
    return "".join([*out, text[last:]])


def redact(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` with all spans of ``find`` in ``text`` replaced by their kinds' names, row by row; null
    stays null. ``n_chars``, where it is there, becomes the new length of changed texts. All
    columns and rows stay, whatever other columns are called; repeated rows stay repeated, an empty table
    stays empty. Time grows with a text's length, whatever runs of digits, dots or letters it holds."""
    weights = fit(docs)
    at = docs.columns.index("text")
    chars = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches):
        let_go()
        chance = _chances(weights) if weights is not None else None
        for batch in text_slices(batches, at):
            texts = batch.column(at).to_pylist()
            new = []
            sizes = batch.column(chars).to_pylist() if chars is not None else None
            for i, t in enumerate(texts):
                spans = all_spans(t, chance, threshold)[1] if t else []
                if spans:
                    t = mask(t, spans)
                    if sizes is not None:
                        sizes[i] = len(t)
                new.append(t)
            cols = list(batch.columns)
            cols[at] = pa.array(new, batch.schema.field(at).type)
            if sizes is not None:
                cols[chars] = pa.array(sizes, batch.schema.field(chars).type)
            yield pa.record_batch(cols, batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
