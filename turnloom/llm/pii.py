"""Personal data: spans fixed by format, and further spans chosen among candidates by boosted trees.

The base kinds (email, ip, card, phone) follow fixed patterns and checks and are always reported. Besides, generators of high recall
propose candidates that may overlap: values that a name such as ``token`` or ``password`` is given, long mixed runs of
letters and digits, digit groups with separators, account numbers, addresses written out in words. Boosted trees score each by its format
and by the words around it; the score is calibrated to a probability, each kind has a threshold chosen on held-out rows
for a wanted precision, and among overlapping candidates the most probable stays; but the whole value given to a name goes
before a run that is only part of it. The trees are trained here on ``TRAINING`` made-up candidates a kind and a third
as many long secrets (a bounded, seeded sample; no row of any table is used).

Defined results. Null text: like empty text, no spans. Offsets count code points, ends are exclusive. Candidates that
overlap a base span go, but a secret with a card or phone number in it stays as the pieces around that, if they have
``RUN`` characters together. Secrets have no largest length. Scans are linear in the text: patterns start at digits, at
``@`` or at an assignment only.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import BoostedTrees

BASE = ("email", "ip", "card", "phone")
EXTRA = ("account", "address", "number", "secret")
TRAINING, PRECISION, RUN = 1500, 0.99, 20
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_IP = re.compile(r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ASSIGNED = re.compile(r"""(?i)(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|key|credential|auth)["']?[\x20\t]{0,3}[=:][\x20\t]{0,3}["']?""")
_VALUE = re.compile(r"""[^\s"']{6,}+""")
_MIXED = re.compile(r"[A-Za-z0-9_/+=-]{20,}+")
_GROUPS = re.compile(r"\(?[0-9]{2,4}\)?(?:[ .\-/][0-9]{2,4}){1,4}")
_ACCOUNT = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?")
_SPELLED = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,63}(?: ?(?:[\[(] ?dot ?[\])]|\.) ?[A-Za-z0-9-]{1,63}){1,4}", re.I)
_SPELLED_AT = re.compile(r"[\[(] ?at ?[\])]", re.I)
_NAMES = re.compile(r"[=:]")
_CUES = (re.compile(r"(?i)(?:token|secret|passw|pwd|key|credential|auth)[^\n]{0,12}$"), re.compile(r"(?i)(?:tel|phone|call|fax|mobile|cell|contact)[^\n]{0,12}$"), re.compile(r"(?i)(?:ssn|social|passport|iban|account|konto|tax)[^\n]{0,12}$"), re.compile(r"(?i)(?:version|page|isbn|commit|sha|chapter|vol|v\.?|no\.?|\$|eur|year|ratio)[^\n]{0,6}$"))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by kind, then start: what leftmost non-overlapping matching of the four patterns gives, with the failing matches dropped."""
    found: dict[str, list[tuple[str, int, int]]] = {k: [] for k in BASE}
    at, over = text.find("@"), 0
    while at >= 0:
        start = at
        while start > over and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            found["email"].append(("email", start, m.end()))
            over = m.end()
        else:
            over = max(over, at + 1)
        at = text.find("@", over)
    ip = card = phone = 0
    for run in _DIGITS.finditer(text):
        s = run.start()
        if s >= ip and (m := _IP.match(text, s)):
            ip = m.end()
            if all(map(_small, m[0].split("."))):
                found["ip"].append(("ip", s, ip))
        if s >= card and (m := _CARD.match(text, s)):
            card = m.end()
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found["card"].append(("card", s, card))
        if s > phone and text[s - 1] == "+" or s - 1 == phone == 0 and text[:1] == "+":
            if m := _PHONE.match(text, s - 1):
                phone = m.end()
                if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                    found["phone"].append(("phone", s - 1, phone))
    return [x for k in BASE for x in found[k]]


def assigned(text: str) -> list[tuple[str, int, int]]:
    """Whole values that names of secrets are given, from left to right; none overlap."""
    out, over = [], 0
    for sign in _NAMES.finditer(text):
        if (s := sign.start()) >= over:
            for m in _ASSIGNED.finditer(text, max(0, s - 24), min(len(text), s + 6)):
                if m.start() < s < m.end() and (value := _VALUE.match(text, m.end())):
                    out.append(("secret", *value.span()))
                    over = value.end()
    return out


def candidates(text: str, named: list[tuple[str, int, int]] | None = None) -> list[tuple[str, int, int]]:
    """Proposed spans of the extra kinds, which may overlap, with ``named`` (those of ``assigned``); linear in the text."""
    out = set(assigned(text) if named is None else named)
    looked = [0, 0, 0, 0]  # for mixed runs, groups, accounts, words with digits: up to where
    for run in _DIGITS.finditer(text):
        s = run.start()
        if s >= looked[0]:
            a = s
            while a > looked[0] and _is_mixed(text[a - 1]):
                a -= 1
            if (m := _MIXED.match(text, a)) and any(map(str.isalpha, m[0])):
                out.add(("secret", a, m.end()))
            looked[0] = max(looked[0], m.end() if m else run.end())
        if s >= looked[1] and run.end() - s <= 4:
            a = s - (s > looked[1] and text[s - 1] == "(")
            if (m := _GROUPS.match(text, a)) and sum(map(str.isdigit, m[0])) >= 7:
                out.add(("number", a, m.end()))
            looked[1] = max(looked[1], m.end() if m else run.end())
        if s >= looked[2] + 2 and run.end() - s >= 2 and (m := _ACCOUNT.match(text, s - 2)):
            out.add(("account", s - 2, m.end()))
            looked[2] = m.end()
    over = 0
    for sign in _SPELLED_AT.finditer(text) if "at" in text or "AT" in text else ():
        if sign.start() >= over:
            left = max(over, sign.start() - 66)
            if m := _SPELLED.search(text, left, min(len(text), sign.end() + 330)):
                if m.start() < sign.start() < m.end():
                    out.add(("address", m.start(), m.end()))
                    over = m.end()
    return sorted(out)


def _is_mixed(c: str) -> bool:
    return c.isascii() and (c.isalnum() or c in "_/+=-")


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format of the span, and the context of 32 characters before and 8 after."""
    span, before, after = text[start:end], text[max(0, start - 32) : start], text[end : end + 8]
    n = len(span)
    digits, upper, lower = (sum(map(f, span)) for f in (str.isdigit, str.isupper, str.islower))
    counts: dict[str, int] = {}
    for c in span:
        counts[c] = counts.get(c, 0) + 1
    entropy = -sum(v / n * math.log2(v / n) for v in counts.values()) if n else 0.0
    hexes = sum(c in "0123456789abcdefABCDEF" for c in span)
    changes = sum(a.isdigit() != b.isdigit() for a, b in zip(span, span[1:]))
    vowels = sum(c in "aeiouAEIOU" for c in span)
    longest = max((len(x) for x in re.findall(r"[A-Za-z]+", span)), default=0)
    groups = [len(x) for x in _DIGITS.findall(span)]
    return [
        float(EXTRA.index(kind)), n, digits / n, upper / n, lower / n, entropy, hexes / n, changes / n, vowels / n, longest, len(groups), groups[0] if groups else 0, groups[-1] if groups else 0,
        digits, sum(c in " .-/()" for c in span) / n, *(float(bool(c.search(before))) for c in _CUES), float(before[-1:] in ('"', "'")), float(bool(re.search(r"[=:]\s?[\"']?$", before))), float(before[-1:].isalnum() or after[:1].isalnum()),
    ]


def training_rows(per_kind: int = TRAINING, seed: int = 7) -> tuple[list[tuple[str, str, int, int]], list[int]]:
    """Made-up candidates in made-up sentences: (text, kind, start, end) and whether each is personal or secret."""
    rng = random.Random(seed)
    pick, digits = rng.choice, lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(pick(["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "le", "oi", "sch", "ció", "a", "e", "o"]) for _ in range(rng.randint(1, 5)))
    chars = lambda alphabet, n: "".join(pick(alphabet) for _ in range(n))
    hexes, wide = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    quote = lambda x: pick(['"%s"', "'%s'", "%s"]) % x

    def secret_yes():
        value = pick([lambda: chars(hexes, pick([32, 40, 64])), lambda: chars(hexes.upper(), pick([32, 40])), lambda: chars(wide, rng.randint(20, 48)), lambda: pick(["sk", "ghp", "AKIA"]) + pick(["-", "_", ""]) + chars(wide, rng.randint(16, 36)), lambda: word() + digits(3) + pick("!#$%") + chars(wide, 5)])()
        return pick(["token = ", "TOKEN = ", "api_key: ", "secret=", "password: ", "passwd = ", "access_key = ", "Auth token: ", "key = "]), value, True

    def secret_no():
        value = pick([lambda: "-".join(word() for _ in range(6)) + digits(2), lambda: word() + "/" + word() + "/" + word() + "/page" + digits(3), lambda: digits(4) + "-" + word() + "-" + word() + "-" + word() + "-" + word(), lambda: "=" * 20 + digits(2), lambda: word() + digits(1) + word() + word() + word() + word() + word() + word(), lambda: "--------------------" + digits(1)])()
        return pick(["see ", "http://", "the ", "in ", "key: ", "/", "version "]), value, False

    def secret_word():
        return pick(["key: ", "Key = ", "token: ", "secret: ", "password: "]), pick([word() + word(), "required", "optional", "something", word() + "," + word(), "(none)", "forgotten"]), False

    def number_yes():
        value = pick([lambda: f"({digits(3)}) {digits(3)}-{digits(4)}", lambda: f"{digits(3)}-{digits(3)}-{digits(4)}", lambda: f"{digits(3)}.{digits(3)}.{digits(4)}", lambda: f"0{digits(2)} {digits(4)} {digits(4)}", lambda: f"{digits(3)}-{digits(2)}-{digits(4)}", lambda: f"0{digits(1)} {digits(2)} {digits(2)} {digits(2)} {digits(2)}"])()
        return pick(["call ", "phone: ", "tel. ", "mobile ", "SSN ", "contact ", "fax: ", "ssn: ", "Tel: "]), value, True

    def number_no():
        value = pick([lambda: f"20{digits(2)}-0{digits(1)}-1{digits(1)}", lambda: f"{digits(2)}/{digits(2)}/19{digits(2)}", lambda: f"{digits(4)} {digits(4)} {digits(4)}", lambda: f"19{digits(2)} 19{digits(2)}", lambda: f"{digits(3)} {digits(3)} {digits(3)}", lambda: f"{digits(4)}-{digits(4)}", lambda: f"{digits(2)}.{digits(3)}.{digits(3)}", lambda: f"{digits(3)}.{digits(2)}.{digits(3)}.{digits(2)}"])()
        return pick(["in ", "pages ", "of ", "$", "ISBN ", "version ", "the ", "", "from "]), value, False

    def account_yes():
        return pick(["IBAN ", "iban: ", "account ", "Konto ", "pay to "]), pick(["DE", "FR", "ES", "GB", "NL"]) + digits(2) + pick(["", " "]).join([chars("0123456789", 4) for _ in range(rng.randint(3, 5))]) + pick(["", digits(2)]), True

    def account_no():
        return pick(["model ", "part ", "the ", "", "see "]), chars("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 2) + digits(2) + pick(["", " "]).join([chars("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"[: pick([26, 36])], 4) for _ in range(rng.randint(2, 3))]), False

    def address_yes():
        a, d = pick([(" [at] ", " [dot] "), ("(at)", "(dot)"), (" (at) ", "."), (" [AT] ", " [DOT] ")])
        return pick(["mail ", "contact: ", "write to ", "", "the "]), word() + pick([".", "_", ""]) + word() + a + word() + d + pick(["com", "org", "net", "de", "fr"]), True

    def address_no():
        return pick(["look ", "we met ", "the price "]), word() + " (at) " + word() + "." + word() + pick([" .", "."]) + word(), False

    def long_yes():
        n = int(65 * 100 ** rng.random())
        value = pick([lambda: chars(hexes, n), lambda: chars(wide, n), lambda: chars(wide + "+/", n) + "==", lambda: ".".join(chars(wide + "-_", max(20, n // 3)) for _ in range(3)), lambda: chars(wide + "!#$%&*.,;:?@^~", n)])()
        return pick(["token = ", "TOKEN=", "api_key: ", "secret=", "password: ", "access_key = ", "Auth token: ", "key = "]), value, True

    def long_no():
        n = rng.randint(8, 400)
        value = pick([lambda: "/".join(word() for _ in range(n)) + "/page" + digits(3), lambda: "-".join(word() for _ in range(n)) + "-" + digits(2), lambda: pick("=-_") * (8 * n) + digits(2), lambda: "_".join(pick([word(), digits(2)]) for _ in range(n)), lambda: ",".join(word() for _ in range(n))])()
        return pick(["see ", "http://", "the ", "in ", "key: ", "/", "version "]), value, False

    rows, labels = [], []
    makers = {"secret": (secret_yes, secret_no, secret_yes, secret_word), "number": (number_yes, number_no), "account": (account_yes, account_no), "address": (address_yes, address_no)}
    for kind, some, n in [*((k, x, per_kind) for k, x in makers.items()), ("secret", (long_yes, long_no), per_kind // 3)]:
        for i in range(n):
            lead, value, good = some[i % len(some)]()
            head = " ".join(word() for _ in range(rng.randint(0, 6))) + pick([" ", "\n", " | ", ". "]) + lead
            tail = pick([" ", ".", ",", "\n", "!! ", "%%% ", " | "]) + " ".join(word() for _ in range(3))
            shown = quote(value) if kind == "secret" else value
            text = head + shown + tail
            start = len(head) + (shown != value)
            rows.append((text, kind, start, start + len(value)))
            labels.append(int(good))
    return rows, labels


class Model:
    """Trees grown on half of the made-up rows, calibrated on a quarter, with thresholds chosen on the last quarter."""

    def __init__(self, per_kind: int = TRAINING, precision: float = PRECISION):
        rows, labels = training_rows(per_kind)
        x, y = np.array([features(*r) for r in rows]), np.array(labels, float)
        part = np.arange(len(y)) // 4 % 4
        self.trees = BoostedTrees().fit(x[part < 2], y[part < 2]).calibrate(x[part == 2], y[part == 2])
        self.threshold, p = {}, self.trees.probability(x)
        for k, kind in enumerate(EXTRA):
            own = (part == 3) & (x[:, 0] == k)
            order = np.argsort(-p[own], kind="stable")
            right = np.cumsum(y[own][order]) / np.arange(1, own.sum() + 1)
            good = np.flatnonzero(right >= precision)
            self.threshold[kind] = float(max(0.5, p[own][order][good[-1]])) if len(good) else 1.1

    def choose(self, text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """The extra spans: over their threshold, clear of base spans, the most probable of those that overlap, whole values first."""
        named = assigned(text)
        proposed = candidates(text, named)
        if not proposed:
            return []
        p = self.trees.probability(np.array([features(text, *c) for c in proposed]))
        good = [i for i in range(len(proposed)) if p[i] >= self.threshold[proposed[i][0]]]
        passed = {proposed[i] for i in good}
        values = [x[1:] for x in named if x in passed]
        starts = [s for s, _ in values]
        taken, digits, out = _joined([x[1:] for x in base]), _joined([x[1:] for x in base if x[0] in ("card", "phone")]), []
        for i in sorted(good, key=lambda i: (-p[i], proposed[i])):
            kind, s, e = proposed[i]
            pieces = [(s, e)]
            if kind == "secret":
                if any(_more(text, *x, s, e) for x in values[max(0, bisect_right(starts, s) - 1) : bisect_left(starts, e)] if x[1] > s):
                    continue
                pieces = _around(digits, s, e)
                if pieces != [(s, e)] and sum(b - a for a, b in pieces) < RUN:
                    continue
            if not any(_overlaps(taken, a, b) for a, b in pieces):
                for a, b in pieces:
                    out.append((kind, a, b))
                    taken.insert(bisect_left(taken, (a, b)), (a, b))
        return sorted(out)


def _more(text: str, a: int, b: int, start: int, end: int) -> bool:
    """Whether a to b has more than closing punctuation outside start to end."""
    return a < start or bool(text[end:b].strip(".,;:)]}>"))


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same places as sorted spans that do not overlap."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _around(spans: list[tuple[int, int]], start: int, end: int) -> list[tuple[int, int]]:
    """What is left of start to end without the spans, which are sorted and do not overlap."""
    out = []
    for s, e in spans[max(0, bisect_left(spans, (start, start)) - 1) : bisect_left(spans, (end, end))]:
        if e > start:
            if s > start:
                out.append((start, s))
            start = e
    return [*out, (start, end)] if start < end else out


def _overlaps(taken: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether any of the spans, which are sorted and do not overlap, meets start to end."""
    i = bisect_left(taken, (end, end)) - 1
    return i >= 0 and taken[i][1] > start


_models: list[Model] = []


def model() -> Model:
    """Trained once, by the driver; the trees, some kilobytes, go with the tasks."""
    if not _models:
        _models.append(Model())
    return _models[0]


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Each span, or run of overlapping spans, replaced by the kind of its first in brackets."""
    out, over = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= over:
            out += [text[over:s], f"[{kind.upper()}]"]
        over = max(over, e)
    return "".join(out) + text[over:]


def find_pii(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans and, if asked for, redacted (null for a null text)."""
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string" + ", redacted string" * with_text

    chooser = model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in schema.split(", ")]
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text or "")
                every = base + chooser.choose(text or "", base)
                n = [sum(k == x for k, _, _ in base) for x in BASE]
                rows.append((*n, hashlib.sha256(listed(base).encode()).hexdigest(), listed(every), *([None if text is None else redact(text, every)] if with_text else [])))
            columns = list(zip(*rows)) if rows else [()] * (len(names) - 1)
            kinds = [pa.int64()] * 4 + [pa.string()] * (2 + with_text)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def redacted(docs: DataFrame) -> DataFrame:
    """The documents themselves, all columns in their order, with every span in the text replaced by its kind."""

    chooser = model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text or "")
                spans = base + chooser.choose(text or "", base)
                out.append(redact(text, spans) if spans else text)
            yield batch.set_column(batch.schema.get_field_index("text"), batch.schema.field("text"), pa.array(out, batch.schema.field("text").type))

    return docs.mapInArrow(run, docs.schema)
