"""Personal data: base formats, then further spans chosen by boosted trees.

The base formats (email, ip, card, phone) always stay. High-recall generators propose more
spans of the same kinds (written-out addresses, phone numbers without a plus sign, cards of
other lengths or separators, IPv6) and secrets (long tokens of mixed characters), which may
overlap; trees score each from its format and its context, and what passes its kind's
calibrated threshold and overlaps no better span is added. The trees are grown here from
generated examples, so that no person's data is in the model, and hold a few kilobytes.

Defined results: a null text has no spans and stays null; an empty one has none; texts of any
length are taken whole; offsets are code points of the whole text, end exclusive; of
candidates that overlap the likelier stays, of equal ones the earlier, then the longer; each
row is by itself, so repeated rows have equal results and an empty table stays empty; columns
of the input that are named like a result are replaced, all others kept.
"""

from __future__ import annotations

import ipaddress
import random
import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidelog.llm import shared, worker
from tidelog.llm.boosting import Trees

KINDS = ("email", "ip", "card", "phone")
#: The kinds of base formats, then what the trees alone find.
ALL_KINDS = (*KINDS, "secret")
_AFTER_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT, _LETTER = re.compile(r"[0-9]"), re.compile(r"[A-Za-z]")

# The generators of further candidates.
_WRITTEN_EMAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\s?(?:\(at\)|\[at\]|\bat\b|@)\s?[A-Za-z0-9-]{1,63}"
    r"(?:(?:\s?(?:\(dot\)|\[dot\]|\bdot\b)\s?|\.)[A-Za-z0-9-]{2,24}){1,3}"
)
_AT = re.compile(r"\(at\)|\[at\]|\bat\b|@")
_IPV6 = re.compile(r"(?<![0-9A-Za-z:.])[0-9A-Fa-f:]{3,45}(?![0-9A-Za-z:])")
_SECRET = re.compile(r"(?<![A-Za-z0-9_+/=.-])[A-Za-z0-9_+/-]{16,512}={0,2}(?![A-Za-z0-9_+/=-])")
_PLAIN_PHONE = re.compile(r"(?<![0-9+A-Za-z._/-])[0-9]{9,12}(?![0-9A-Za-z_/-])")
_LOOSE_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20.\-/]?[0-9]){12,18}(?![0-9])")
_LOOSE_PHONE = re.compile(r"(?<![0-9+])(?:00[0-9]{1,3}[ .-]?)?\(?[0-9]{2,4}\)?[ .\-/][0-9]{2,4}(?:[ .\-/][0-9]{2,4}){1,3}(?![0-9])")

# Fixed words of context.
_WORDS = {
    "phone": ("phone", "tel", "call", "mobile", "cell", "fax", "whatsapp", "contact", "dial"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "payment", "pan"),
    "email": ("mail", "contact", "write", "reach", "address", "e-mail"),
    "ip": ("ip", "host", "server", "address", "ping", "ssh", "login"),
    "secret": ("token", "secret", "key", "apikey", "password", "passwd", "pwd", "auth", "bearer", "credential", "credentials"),
    "other": ("version", "order", "invoice", "isbn", "ticket", "serial", "chapter", "section", "date", "page", "id", "no", "price", "total", "commit", "file", "sha", "image", "uuid"),
}
#: Usual last parts of host names.
_ENDINGS = frozenset(("com", "org", "net", "edu", "gov", "io", "info", "biz", "de", "fr", "es", "it", "nl", "pt", "uk", "us", "ch", "at", "eu"))
_NEAR = {k: re.compile(r"(?<![a-z])(?:" + "|".join(v) + r")(?![a-z])") for k, v in _WORDS.items()}
CONTEXT = 32


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base formats, by kind as in KINDS and then by start."""
    out = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _AFTER_AT.match(text, at) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(part) <= 3 and int(part or 0) <= 255 for part in (p.lstrip("0") for p in m[0].split("."))):
                out.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= sum(map(str.isdigit, m[0])) <= 15:
                    out.append(("phone", *m.span()))
    return out


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Spans that may be personal data, overlaps included."""
    out = []
    if _AT.search(text):
        out += [("email", *m.span()) for m in _WRITTEN_EMAIL.finditer(text)]
    if _DIGIT.search(text):
        out += [("card", *m.span()) for m in _LOOSE_CARD.finditer(text)]
        out += [("phone", *m.span()) for m in _LOOSE_PHONE.finditer(text)]
        out += [("phone", *m.span()) for m in _PLAIN_PHONE.finditer(text)]
        out += [("secret", *m.span()) for m in _SECRET.finditer(text) if _DIGIT.search(m[0]) and _LETTER.search(m[0])]
    if ":" in text:
        out += [("ip", *m.span()) for m in _IPV6.finditer(text) if m[0].count(":") > 1]
    return out


def features(text: str, kind: str, start: int, end: int) -> list[int]:
    """Format and context of a candidate, as small integers."""
    span = text[start:end]
    digits = re.sub(r"[^0-9]", "", span)
    before, after = text[max(0, start - CONTEXT) : start].lower(), text[end : end + CONTEXT].lower()
    kinds = {c for c in span if not c.isalnum()}
    prior, following = text[start - 1 : start], text[end : end + 1]
    letters = [c for c in span if c.isalpha()]
    return [
        ALL_KINDS.index(kind),
        min(len(span), 63),
        min(len(digits), 24),
        min(sum(not c.isalnum() for c in span), 15),
        len(kinds - {" "}),
        int(bool(digits) and luhn(digits)),
        int(digits[:1] in ("3", "4", "5", "6")),
        int(span.startswith("(") or ") " in span),
        int(span.startswith("00")),
        int("dot" in span) + int("at" in span),
        int("(" in span) + int("[" in span),
        int(bool(re.fullmatch(r"(19|20)[0-9]{2}[-./ ][0-9]{1,2}[-./ ][0-9]{1,2}", span)) or bool(re.fullmatch(r"[0-9]{1,2}[-./ ][0-9]{1,2}[-./ ](19|20)[0-9]{2}", span))),
        int(prior.isalnum()) + 2 * int(prior in "#$€£:=/" and prior != ""),
        int(following.isalnum()) + 2 * int(following in "%/:=" and following != ""),
        *[int(bool(_NEAR[k].search(before))) for k in (*ALL_KINDS, "other")],
        *[int(bool(_NEAR[k].search(after))) for k in ("phone", "other")],
        int(kind == "ip" and _is_ipv6(span)),
        int(kind == "email" and span.lower().rpartition(".")[2].rpartition("dot")[2].strip(" )]") in _ENDINGS),
        min(len(letters), 63),
        min(len(set(span)), 40),
        int(any(c.isupper() for c in letters)) + 2 * int(any(c.islower() for c in letters)),
        int(all(c in "abcdefABCDEF" for c in letters)),
        min(len(re.findall(r"[0-9]+", span)), 31),
        int(prior in "\"'`" and prior != "") + 2 * int(bool(re.search(r"[=:]\s?[\"'`]?$", before))),
    ]


def _is_ipv6(span: str) -> bool:
    try:
        ipaddress.IPv6Address(span)
    except ValueError:
        return False
    return span != "::"


def _examples(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Generated candidates: about half are personal data, the rest look like it."""
    r = random.Random(seed)
    num = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    word = lambda: "".join(r.choice("abcdefghijklmnoprstuvw") for _ in range(r.randint(2, 9)))
    x, y = [], []

    def card(good: bool, k: int, sep: str) -> str:
        while True:
            d = r.choice("3456") + num(k - 1)
            if luhn(d) == good:
                return sep.join(d[i : i + 4] for i in range(0, k, 4))

    while len(y) < n:
        kind, yes = r.choice(ALL_KINDS), r.random() < 0.5
        near = r.choice(_WORDS[kind]) if yes and r.random() < 0.85 else r.choice(_WORDS["other"]) if not yes and r.random() < 0.6 else word()
        if kind == "card":
            body = card(yes or r.random() < 0.1, r.choice((13, 14, 15, 16)), r.choice(("", " ", "-", ".", "/")))
        elif kind == "phone":
            sep = r.choice(" .-/")
            if yes:
                body = r.choice((num(9), num(10), num(11), f"({num(3)}) {num(3)}-{num(4)}", sep.join((num(3), num(3), num(4))), f"00{num(2)} {num(3)} {num(3)} {num(3)}", sep.join((num(2), num(4), num(4)))))
                if body.isdigit() and near not in _WORDS["phone"]:
                    yes = False  # a bare number says nothing by itself
            else:
                body = r.choice((num(9), num(10), num(12), f"{r.randint(1900, 2090)}-{r.randint(10, 12)}-{r.randint(10, 28)}", sep.join((num(2), num(2), num(4))), sep.join((num(4), num(4), num(4), num(4))), sep.join(num(r.randint(2, 4)) for _ in range(r.randint(3, 5)))))
        elif kind == "email":
            marked = ((" (at) ", " (dot) "), (" [at] ", " [dot] "), (" at ", " dot "), ("(at)", "(dot)"), (" (at) ", "."), ("[at]", "."), ("(at)", " dot "))
            at, dot = r.choice(marked) if yes else r.choice(((" at ", "."), (" at ", " dot "), (" at", " dot ")))
            body = f"{word()}{at}{word()}{dot}{r.choice(('com', 'org', 'net', 'de', 'fr', 'io')) if yes else word()}"
        elif kind == "ip":
            whole = [r.choice(("%x", "%x", "%04x")) % r.randint(0, 65535) for _ in range(8)]
            at = r.randint(1, 6)
            short = ":".join(whole[:at]) + "::" + ":".join(whole[at : r.randint(at + 1, 7)])
            times = ":".join(num(2) for _ in range(r.randint(3, 6)))
            pair = "::".join("".join(r.choice("abcdef") for _ in range(r.randint(1, 4))) for _ in range(2))
            body = r.choice((":".join(whole), short, short, "fe80::" + ":".join(whole[4:]))) if yes else r.choice((times, times, pair, ":".join(whole[: r.randint(3, 7)])))
        else:
            mixed = "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789" + "+/" * r.randint(0, 1)) for _ in range(r.randint(20, 64)))
            digits_of = lambda k: "".join(r.choice("0123456789abcdef") for _ in range(k))
            names = r.choice("_-/").join([word() for _ in range(r.randint(3, 6))] + [num(r.randint(1, 4))])
            secret = r.choice((digits_of(32), digits_of(40), digits_of(64), mixed, f"{word()}_{mixed}", "AKIA" + mixed[:16].upper()))
            secret = secret.upper() if r.random() < 0.1 else secret
            body = secret if yes else r.choice((names, names, word() * 4 + num(2), f"IMG_{num(8)}_{num(6)}", "-".join(digits_of(k) for k in (8, 4, 4, 4, 12)), digits_of(40), num(18) + r.choice("ab")))
            if not yes and body.isalnum() and len(body) == 40 and near not in _WORDS["other"]:
                near = r.choice(("commit", "sha"))
            if yes and near not in _WORDS["secret"] and len(body) < 32:
                near = r.choice(_WORDS["secret"])
        quote = r.choice(("", '"', "'")) if kind == "secret" else ""
        link = r.choice((": ", " = ", "=", " ")) if kind == "secret" else r.choice((": ", " ", " "))
        near = near.upper() if r.random() < 0.1 else near
        lead = " ".join(word() for _ in range(3)) + f" {near}{link}{quote}"
        text = f"{lead}{body}{quote} {word()} {word()}"
        x.append(features(text, kind, len(lead), len(lead) + len(body)))
        y.append(int(yes))
    return np.array(x), np.array(y, float)


#: Generated examples that the trees are grown on, and as many for calibration.
EXAMPLES = 6000
#: Least share of personal data among what a threshold lets pass.
PRECISION = 0.98


@lru_cache(maxsize=1)
def model() -> tuple[Trees, dict[str, float]]:
    """The trees and each kind's threshold, from generated examples; the same in every process."""
    trees = Trees().fit(*_examples(EXAMPLES, 1))
    x, y = _examples(EXAMPLES, 2)
    p = trees.calibrate(x, y).probability(x)
    thresholds = {}
    for k, kind in enumerate(ALL_KINDS):
        own = x[:, 0] == k
        order = np.argsort(-p[own])
        right = np.cumsum(y[own][order]) / np.arange(1, own.sum() + 1)
        good = np.flatnonzero(right >= PRECISION)
        thresholds[kind] = max(0.9, float(p[own][order][good[-1]])) if len(good) else 1.1
    return trees, thresholds


def find(text: str, trees: Trees, thresholds: dict[str, float]) -> tuple[list, list]:
    """(base spans, all spans), both by kind as in ALL_KINDS and then by start."""
    base = base_spans(text)
    more = [c for c in candidates(text) if not any(k == c[0] and s < c[2] and c[1] < e for k, s, e in base)]
    if not more:
        return base, base
    scores = trees.probability(np.array([features(text, *c) for c in more]))
    kept: list = list(base)
    for score, c in sorted(zip(scores, more), key=lambda x: (-x[0], x[1][1], -x[1][2])):
        if score >= thresholds[c[0]] and not any(s < c[2] and c[1] < e for _, s, e in kept):
            kept.append(c)
    return base, sorted(kept, key=lambda c: (ALL_KINDS.index(c[0]), c[1]))


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with [KIND] for each span; of overlapping ones the first and longest names the place."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda c: (c[1], -c[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    out.append(text[at:])
    return "".join(out)


def _joined(spans: list) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _detector(with_text: bool):
    trees, thresholds = model()
    schema = "n_email long, n_ip long, n_card long, n_phone long, base_spans string, spans string" + ", redacted string" * with_text

    @F.pandas_udf(schema)
    def detect(texts: pd.Series) -> pd.DataFrame:
        worker.enter("pii")
        rows = []
        for text in texts:
            base, spans = find(text, trees, thresholds) if text else ((), ())
            kinds = [b[0] for b in base]
            row = (*(kinds.count(k) for k in KINDS), _joined(base), _joined(spans))
            if with_text:
                row += (redact(text, spans) if spans else text,)
            rows.append(row)
        names = [c.split()[0] for c in schema.split(", ")]
        return pd.DataFrame(rows, columns=names)

    return detect


RESULTS = ("n_email", "n_ip", "n_card", "n_phone", "base_spans", "spans")


def detected(docs: DataFrame) -> DataFrame:
    """docs with counts of the base formats, base_spans and spans (kind:start:end, comma-joined)."""
    own = shared.free(docs, "_pii")
    found = docs.withColumn(own, _detector(False)(F.col("text")))
    return found.withColumns({c: F.col(f"{own}.{c}") for c in RESULTS}).drop(own)


def redacted(docs: DataFrame) -> DataFrame:
    """docs with every span replaced in text, and n_chars of the new text; no other column changes."""
    own = shared.free(docs, "_pii")
    found = docs.withColumn(own, _detector(True)(F.col("text")))
    out = found.withColumn("text", F.col(f"{own}.redacted"))
    if "n_chars" in docs.columns:
        changed = F.length(F.col(f"{own}.spans")) > 0
        out = out.withColumn("n_chars", F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.drop(own).select(*docs.columns)
