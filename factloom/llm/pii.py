"""Personal data by weak supervision.

Base kinds (email, ip, card, phone) come from fixed patterns and always stay. Further candidates - long keys ("secret"),
long digit runs ("account") and id numbers ("idnum") - get votes of three labelers: their shape (regex), cue words before
them (gazetteers by kind) and the characters around them (context). Counts of vote and feature patterns over the whole
corpus (of a bounded number of patterns) feed expectation-maximisation, which estimates from the votes how reliable each
labeler is for each kind. Its posteriors train the final span classifier, a logistic one over features of the span itself
that no labeler sees (length, shares of digits and of distinct characters, case, neighbours) beside the votes, so it can
accept what the labelers abstain on. Spans it accepts are added unless they overlap a base span.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BASE = ("email", "ip", "card", "phone")
ADDED = ("secret", "account", "idnum")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a match starts where a run of digits does, and ends where one does; so inner digits of a run need no attempt
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_CANDIDATE = re.compile(r"(?P<idnum>(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-]))|(?P<account>(?<![0-9A-Za-z])[0-9]{13,19}(?![0-9A-Za-z]))|(?P<secret>(?<![0-9A-Za-z_-])[0-9A-Za-z_-]{20,}(?![0-9A-Za-z_-]))")
# Gazetteers, words that introduce personal data of a kind in English, German, French and Spanish.
GAZETTEERS = {
    "secret": "token secret password passwd passwort passphrase credential credentials apikey api key keys bearer auth authorization session cookie signature private access client webhook clave contraseña kennwort schlüssel geheim zugang jeton clé secrète secreto motdepasse".split(),
    "account": "account acct iban card credit debit bank routing number konto kontonummer karte kartennummer kreditkarte bankverbindung compte carte bancaire crédit numéro cuenta tarjeta crédito banco número visa mastercard amex customer kunde cliente client".split(),
    "idnum": "ssn social security tax taxpayer id identity identification passport license licence steuernummer ausweis personalausweis sozialversicherung identité sécurité sociale passeport permis dni nif nie pasaporte identidad seguridad social".split(),
}
_WORD = re.compile(r"[^\W\d_]+")
_CUES = {kind: frozenset(words) for kind, words in GAZETTEERS.items()}


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if k % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """As the pattern's leftmost matches, but looked for from each @, so long runs of letters cost one pass."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        m = _EMAIL.match(text, start) if start < at else None
        if m:
            out.append(m.span())
            end = m.end()
        else:
            end = at + 1
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Spans of the four base kinds, in order of BASE."""
    digits = [g for m in _CARD.finditer(text) for g in [m.span()] if 13 <= sum(c.isdigit() for c in m.group()) <= 19 and luhn(re.sub("[^0-9]", "", m.group()))]
    ips = [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split("."))] if "." in text else []
    phones = [m.span() for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m.group()) <= 15] if "+" in text else []
    return [_emails(text), ips, digits, phones]


def _around(text: str, a: int, b: int) -> tuple[str, str]:
    """The nearest character on either side that is no space, within two."""
    return text[max(0, a - 2) : a].strip()[-1:], text[b : b + 2].strip()[:1]


def features(kind: str, text: str, a: int, b: int) -> int:
    """Features of a span that the labelers do not vote on, as one of 2,304 numbers."""
    s = text[a:b]
    digits = sum(c.isdigit() for c in s) / len(s)
    length = sum(len(s) >= x for x in (16, 24, 40))
    share = sum(digits >= x for x in (0.1, 0.7))
    varied = sum(len(set(s)) >= x for x in (6, 9, 13))
    cases = any(c.islower() for c in s) + 2 * any(c.isupper() for c in s)
    sides = [0 if not c else 1 if c.isalnum() else 2 if c in "\"'`" else 3 for c in _around(text, a, b)]
    out = 0
    for value, n in zip((length, share, varied, cases, *sides), _SIZES):
        out = out * n + value
    return out


_SIZES = (4, 3, 4, 4, 4, 4)


def candidates(text: str, base: list[list[tuple[int, int]]]) -> list[tuple[str, int, int, tuple[int, int, int]]]:
    """(kind, start, end, votes) of what overlaps no base span; a vote is 1 for, 0 abstains, -1 against."""
    taken = sorted(s for spans in base for s in spans)
    out, k = [], 0
    for m in _CANDIDATE.finditer(text):
        a, b = m.span()
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        if k < len(taken) and taken[k][0] < b:
            continue
        kind, s = m.lastgroup, m.group()
        if kind == "secret":
            mixed = any(c.isdigit() for c in s) and any(c.isalpha() for c in s)
            shape = 1 if mixed and len(set(s)) >= 8 else -1
        else:
            shape = 1 if kind == "idnum" or len(s) in (13, 15, 16) else 0
        words = 1 if not _CUES[kind].isdisjoint(_WORD.findall(text[max(0, a - 40) : a].lower())) else 0
        around = _around(text, a, b)[0]
        context = 1 if around and around in "\"'=:#" else (1 if kind != "secret" and (a == 0 or text[a - 1].isspace()) else -1)
        out.append((kind, a, b, (shape, words, context)))
    return out


def _inputs(kind: str, votes: tuple[int, int, int], code: int) -> list[float]:
    values = []
    for n in reversed(_SIZES):
        code, value = divmod(code, n)
        values += [float(value == x) for x in range(1, n)]
    return [1.0, *[float(kind == k) for k in ADDED[1:]], *[float(v == x) for v in votes for x in (-1, 1)], *values]


def reliabilities(patterns: dict[tuple[str, tuple[int, int, int]], int]) -> dict[tuple[str, tuple[int, int, int]], float]:
    """Counts of vote patterns -> the probability of each that the span is personal data, by expectation-maximisation."""
    if not patterns:
        return {}
    keys = sorted(patterns)
    n = np.array([patterns[k] for k in keys], float)
    post = np.array([0.5 + 0.4 * np.tanh(sum(k[1])) for k in keys])
    for _ in range(50):
        p = np.zeros((len(keys), 2))
        for kind in ADDED:
            own = np.array([k[0] == kind for k in keys])
            if not own.any():
                continue
            for y, r in ((1, post), (0, 1 - post)):
                weight = (n * r)[own]
                like = np.full(own.sum(), np.log(weight.sum() + 1))
                for lab in range(3):
                    votes = np.array([k[1][lab] for k, o in zip(keys, own) if o])
                    # a prior of ten votes holds the labelers to be right more often than wrong
                    prior = {y * 2 - 1: 6.0, 0: 3.0, 1 - 2 * y: 1.0}
                    like += np.log([(weight[votes == v].sum() + prior[v]) / (weight.sum() + 10) for v in votes])
                p[own, y] = like
        post = 1 / (1 + np.exp(np.clip(p[:, 0] - p[:, 1], -30, 30)))
    return dict(zip(keys, post.tolist()))


def train(patterns: dict[tuple[str, tuple[int, int, int], int], int]) -> np.ndarray:
    """Counts of (kind, votes, features) -> weights of the span classifier, trained on the labelers' posteriors."""
    by_votes: dict = {}
    for (kind, votes, _), count in patterns.items():
        by_votes[kind, votes] = by_votes.get((kind, votes), 0) + count
    post = reliabilities(by_votes)
    keys = sorted(patterns)
    x = np.array([_inputs(*k) for k in keys])
    y, n = np.array([post[k[:2]] for k in keys]), np.array([patterns[k] for k in keys], float)
    share = n / n.sum() * len(n) + 1.0
    w = np.zeros(x.shape[1])
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve((x * (share * q * (1 - q))[:, None]).T @ x + 0.1 * np.eye(len(w)), x.T @ (share * (y - q)) - 0.1 * w)
    return w


def _count(batches):
    for batch in batches:
        found: dict = {}
        for text in batch.column(0).to_pylist():
            for kind, a, b, votes in candidates(text, base_spans(text)) if text else ():
                key = (kind, votes, features(kind, text, a, b))
                found[key] = found.get(key, 0) + 1
        keys = list(found)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), *[pa.array([k[1][i] for k in keys], pa.int32()) for i in range(3)], pa.array([k[2] for k in keys], pa.int32()), pa.array([found[k] for k in keys], pa.int64())], ["kind", "a", "b", "c", "code", "n"])


def find_pii(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, ...) -> (doc_id, n_email, n_ip, n_card, n_phone, n_added, n_spans, base_sha256, spans).

    One row for each row of docs. Spans are kind:start:end in code points, end exclusive, base kinds first, then added
    kinds by name and start. Null texts are empty and empty texts have no spans; an empty table gives an empty table;
    repeated rows count in the labelers' statistics as often as they come; rows without doc_id are searched alike. Texts
    are read whole, in time that grows with their length. Only doc_id and text are read, so other columns cannot clash.
    """
    rows = docs.select("text").mapInArrow(_count, "kind string, a int, b int, c int, code int, n long").groupBy("kind", "a", "b", "c", "code").agg(F.sum("n").alias("n")).collect()
    patterns = {(r["kind"], (r["a"], r["b"], r["c"]), r["code"]): r["n"] for r in rows}
    accepted = set()
    if patterns:
        w = train(patterns)
        accepted = {k for k in patterns if np.dot(_inputs(*k), w) >= 0}

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                text = text or ""
                base = base_spans(text)
                more = [(k, a, b) for k, a, b, votes in candidates(text, base) if (k, votes, features(k, text, a, b)) in accepted]
                first = [f"{kind}:{a}:{b}" for kind, spans in zip(BASE, base) for a, b in spans]
                sizes = list(map(len, base))
                out.append((*sizes, len(more), sum(sizes) + len(more), hashlib.sha256(",".join(first).encode()).hexdigest(), ",".join(first + [f"{k}:{a}:{b}" for kind in ADDED for k, a, b in more if k == kind])))
            cols = list(zip(*out)) or [()] * 8
            types = [pa.int64()] * 6 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(cols, types)]], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "n_added", "n_spans", "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, n_added long, n_spans long, base_sha256 string, spans string")
