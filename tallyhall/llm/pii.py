"""Personal data by weak supervision.

Four fixed patterns give the base spans.  Wider patterns give candidates:
whatever stands around an @ or a bracketed "at", dotted and colon-separated
numbers, and groups of 7 to 19 digits.  Labelers of three sorts vote on each
candidate (yes, no, or nothing): regular expressions and checks on its form,
gazetteers (top-level domains, issuer prefixes, calling codes, reserved
ranges) and words of its context.  Nobody labels a span by hand: expectation
maximisation estimates for every labeler how often it says yes, no or nothing
of true and of false candidates, and from that each candidate's probability.
A logistic regression on the span itself (its shape, digits, checks and
neighbouring words, not the votes) is trained on those probabilities and
decides which candidates are spans.

The votes of all candidates are counted by kind and combination, at most
4 x 3^5 numbers, and the expectation maximisation works on those counts.  The
classifier is fitted on a bounded sample of distinct candidates (``sample``),
in one task.  A document's spans are made in its own row, so nothing is
joined back.  Positions are code points.
"""

from __future__ import annotations

import ipaddress
import math
import pickle
import re
from bisect import bisect_left, insort
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_type, saved, table
from .tokens import slices

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 50_000
THRESHOLD = 0.5

# The base patterns.  Runs are taken whole (possessive), so a
# run that leads to no match is read once and not again from each character.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]++(@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)?+")
IP = re.compile(r"[0-9]++(?:\.([0-9]++)\.([0-9]++)\.([0-9]++))?+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORTH = r"[0-9@]|[\[({] ?(?i:at) ?[\])}]"  # a text without these has no span and no candidate

# Wider patterns.
_BEFORE_AT = re.compile(r"[^\s@,;:<>()\[\]{}\"'/|=]{1,64}$")
_AFTER_AT = re.compile(r"[^\s@,;:<>()\[\]{}\"'/|=]{1,255}")
_SPELLED = re.compile(r"\s?[\[({] ?(?:at|AT) ?[\])}]\s?")
_SPELLED_DOMAIN = re.compile(r"[\w-]{1,63}(?:\s?(?:\.|[\[({] ?(?:dot|DOT) ?[\])}])\s?[\w-]{1,63}){1,8}")
_COLONS = re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:])")
_NUMBER = re.compile(r"\+?\(?[0-9]++\)?(?:[\x20./-]?\(?[0-9]++\)?)*+")
_WORD = re.compile(r"[^\W\d_]+")
_DATE = re.compile(r"(?:[0-9]{4}[-./][0-9]{1,2}[-./][0-9]{1,2}|[0-9]{1,2}[-./][0-9]{1,2}[-./][0-9]{2,4})")
_THOUSANDS = re.compile(r"[0-9]{1,3}(?:([\x20.])[0-9]{3})(?:\1[0-9]{3})*")
_GROUPED = re.compile(r"\+?[0-9]{0,3}[\x20.-]?(?:\([0-9]{2,5}\)|[0-9]{2,5})[\x20./-][0-9]{2,4}(?:[\x20.-][0-9]{2,4}){0,3}")

# Gazetteers and context words (fixed values).
DOMAINS = frozenset("com org net edu gov mil int info biz name io co ai app dev me tv de fr es it nl be at ch uk ie pt pl se no dk fi cz "
                    "gr hu ro ru ua tr us ca mx br ar cl au nz jp cn kr in za eu".split())
ISSUERS = ((r"4", (13, 16, 19)), (r"5[1-5]|2(?:22[1-9]|2[3-9]|[3-6]|7[01]|720)", (16,)), (r"3[47]", (15,)),
           (r"6(?:011|4[4-9]|5)", (16, 17, 18, 19)), (r"35(?:2[89]|[3-8])", (16, 17, 18, 19)), (r"3(?:0[0-5]|[689])", (14, 16, 19)),
           (r"62", (16, 17, 18, 19)))
CALLING = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 "
                    "90 91 92 93 94 95 98 212 213 216 351 352 353 354 355 356 357 358 359 370 371 372 380 385 386 420 421".split())
YES_WORDS = {"email": "email mail mailto contact kontakt write reply correo courriel schreiben escribir écrire",
             "ip": "ip ipv host server address addr adresse dirección client login peer from",
             "card": "card visa mastercard amex credit debit karte kreditkarte carte tarjeta payment paid pay",
             "phone": "tel telephone phone call mobile cell fax whatsapp sms telefon anruf handy téléphone appel appeler teléfono llamar móvil"}
NO_WORDS = {"email": "class import package npm git version", "ip": "version release section chapter v build firmware oid",
            "card": "isbn order invoice tracking serial imei id ean sku hash number nr", "phone": "isbn order invoice id ean sku version serial"}
_YES = {k: frozenset(v.split()) for k, v in YES_WORDS.items()}
_NO = {k: frozenset(v.split()) for k, v in NO_WORDS.items()}

# How far each sort of labeler is trusted before any data is seen: the share
# of its yes and no votes that are right; a check is an arithmetic fact.
TRUST = {"regex": 0.8, "gazetteer": 0.75, "context": 0.85, "check": 0.99}
LABELERS = {"email": ("regex", "regex", "gazetteer", "context", "check"), "ip": ("regex", "check", "gazetteer", "context", "regex"),
            "card": ("regex", "check", "gazetteer", "context", "regex"), "phone": ("regex", "regex", "gazetteer", "context", "check")}
LABELERS_EACH = 5
PRIOR_WEIGHT, PRIOR_YES, PRIOR_NO = 40.0, 4.0, 6.0


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _at_most_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind's number, start, end) of the base patterns, by kind and start."""
    out = []
    if "@" in text:
        out += [(0, *m.span()) for m in EMAIL.finditer(text) if m[1]]
    for m in IP.finditer(text):
        if m[1] and all(_at_most_255(p) for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            d = _digits(m[0])
            if 16 <= len(d) <= 19 and luhn(d):
                out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The base spans, and the wider patterns' spans that overlap none of
    them, in order."""
    out = dict.fromkeys(base)
    at = text.find("@")
    while at >= 0:
        left, right = _BEFORE_AT.search(text, max(0, at - 64), at), _AFTER_AT.match(text, at + 1)
        if left and right:
            end = right.end()
            while end > at + 2 and text[end - 1] in ".!?":
                end -= 1
            out.setdefault((0, left.start(), end))
        at = text.find("@", at + 1)
    for m in _SPELLED.finditer(text):
        left, right = _BEFORE_AT.search(text, max(0, m.start() - 64), m.start()), _SPELLED_DOMAIN.match(text, m.end())
        if left and right:
            out.setdefault((0, left.start(), right.end()))
    for m in _COLONS.finditer(text):
        out.setdefault((1, *m.span()))
    for m in _NUMBER.finditer(text):
        if m.end() - m.start() < 7:
            continue
        a, b = m.span()
        if (a and (text[a - 1].isalnum() or text[a - 1] in "_.:-/=")) or (b < len(text) and (text[b].isalnum() or text[b] in "_@:/=")):
            continue
        parts = [(a, b)]
        if b - a > 13 and " " in m[0]:  # a card number between other numbers
            parts += [(a + g.start(), a + g.end()) for g in re.finditer(r"[0-9]{13,19}", m[0])]
        for a, b in dict.fromkeys(parts):
            n = sum("0" <= c <= "9" for c in text[a:b]) if b - a <= 64 else 0
            quad = text.count(".", a, b) == 3 and IP.fullmatch(text, a, b)
            plain = not any(c in "+()./" for c in text[a:b])
            if quad and quad[1]:
                out.setdefault((1, a, b))
            elif 13 <= n <= 19 and plain:
                out.setdefault((2, a, b))
            elif 7 <= n <= 15:
                out.setdefault((3, a, b))
    free = _Free([(a, b) for _, a, b in base])
    own = set(base)
    return sorted(c for c in out if c in own or free(c[1], c[2]))


class _Free:
    """Whether a span overlaps none of some others; more can be added."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.spans: list[tuple[int, int]] = []
        for a, b in sorted(spans):  # those that overlap each other are one
            if self.spans and a < self.spans[-1][1]:
                a, b = self.spans[-1][0], max(b, self.spans.pop()[1])
            self.spans.append((a, b))

    def __call__(self, a: int, b: int) -> bool:
        at = bisect_left(self.spans, (a, -1))
        return (at == 0 or self.spans[at - 1][1] <= a) and (at == len(self.spans) or self.spans[at][0] >= b)

    def add(self, a: int, b: int) -> None:
        insort(self.spans, (a, b))


def _near(text: str, a: int, b: int) -> tuple[list[str], list[str]]:
    """Up to three words before and two after, lower-cased."""
    return [w.lower() for w in _WORD.findall(text[max(0, a - 48):a])][-3:], [w.lower() for w in _WORD.findall(text[b:b + 32])][:2]


def _context(kind: str, before: list[str]) -> int:
    if any(w in _YES[kind] for w in before):
        return 1
    return -1 if before and before[-1] in _NO[kind] else 0


def _email_votes(s: str, before: list[str], after: list[str], is_base: bool) -> list[int]:
    domain = re.sub(r"\s?[\[({] ?(?i:dot) ?[\])}]\s?", ".", s.rsplit("@", 1)[-1] if "@" in s else re.split(r"[\])}]\s?", s, maxsplit=1)[-1])
    top = domain.rsplit(".", 1)[-1].lower() if "." in domain else ""
    shaped = bool(re.fullmatch(r"[\w-]+(\.[\w-]+)*\.[^\W\d_]{2,24}", domain))
    return [1 if is_base else 0, 1 if shaped else -1, 1 if top in DOMAINS else 0, _context("email", before), 0 if top and not top.isdigit() else -1]


def _ip_votes(s: str, before: list[str], after: list[str], is_base: bool) -> list[int]:
    try:
        where = ipaddress.ip_address(".".join(str(int(p)) for p in s.split(".")) if "." in s and ":" not in s and len(s) < 64 else s)
    except ValueError:
        return [0, -1, 0, _context("ip", before), 0]
    full = where.version == 4 or s.count(":") == 7 or len(s) > 9
    return [1 if is_base else 0, 1, -1 if where.is_unspecified or where.is_multicast or where.is_loopback else 0, _context("ip", before),
            1 if full else -1]


def _card_votes(s: str, before: list[str], after: list[str], is_base: bool) -> list[int]:
    d = _digits(s)
    issuer = any(len(d) in sizes and re.match(p, d) for p, sizes in ISSUERS)
    groups = [len(g) for g in re.split(r"[\x20-]", s)]
    usual = len(groups) == 1 or groups[:-1] == [4] * (len(groups) - 1) or groups in ([4, 6, 5], [4, 6, 4])
    return [1 if is_base else 0, 1 if luhn(d) else -1, 1 if issuer else -1, _context("card", before), 1 if usual else -1]


def _phone_votes(s: str, before: list[str], after: list[str], is_base: bool) -> list[int]:
    d = _digits(s)
    code = s[0] == "+" and any(d[:n] in CALLING for n in (1, 2, 3))
    grouped = bool(_GROUPED.fullmatch(s)) and len(re.split(r"[^0-9]+", s.strip("+() "))) > 1
    other = _DATE.fullmatch(s) or _THOUSANDS.fullmatch(s) or (s[0] != "+" and len(set(s) & set(" ().-/")) == 0)
    return [1 if is_base else 0, 1 if grouped and not other else -1, 1 if code or d.startswith("00") else 0, _context("phone", before), -1 if other else 0]


_VOTES = (_email_votes, _ip_votes, _card_votes, _phone_votes)


def votes(text: str, span: tuple[int, int, int], is_base: bool) -> int:
    """The labelers' votes as one number, a base-3 digit each (no, nothing,
    yes)."""
    k, a, b = span
    code = 0
    for v in _VOTES[k](text[a:b], *_near(text, a, b), is_base):
        code = 3 * code + v + 1
    return code


def features(text: str, span: tuple[int, int, int]) -> list[int]:
    """Hashes of what the classifier may know of a span: no votes."""
    k, a, b = span
    s, (before, after) = text[a:b], _near(text, a, b)
    d = _digits(s)
    shape = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]", "9", s[:64]))
    names = ["", "shape " + shape, "form " + re.sub("9+", "9", shape), f"digits {len(d)}", "first " + d[:1], "two " + d[:2],
             *[f"before {i} {w}" for i, w in enumerate(reversed(before))], *[f"after {i} {w}" for i, w in enumerate(after)]]
    if k == 0:
        names.append("top " + s.rsplit(".", 1)[-1].lower()[:24])
    if k == 1:
        names += ["parts " + ("fit" if ":" in s or all(_at_most_255(p) for p in s.split(".")) else "over")]
    if k == 2:
        names += [f"sum {luhn(d)}", f"sum {luhn(d)} first {d[:1]}"]
    return [int.from_bytes(blake2b(f"{k} {x}".encode(), digest_size=8).digest(), "little", signed=True) for x in dict.fromkeys(names)]


def digits_of(code: int) -> list[int]:
    """The votes (0 no, 1 nothing, 2 yes) of a code."""
    return [code // 3 ** i % 3 for i in reversed(range(LABELERS_EACH))]


def expectation_maximisation(kind: str, codes: np.ndarray, counts: np.ndarray, rounds: int = 200, tolerance: float = 1e-9):
    """(probability of each code, share of true candidates, yes[labeler,
    truth]) from the numbers of candidates with each code.

    Base spans (the first labeler's yes) are true; the share is that of the
    others.  ``yes`` is the share of yes among a labeler's votes on false and on true
    candidates.  Whether a labeler votes at all says nothing: most stay
    silent where their word or prefix is missing.  The priors are
    ``PRIOR_WEIGHT`` imagined votes per truth and labeler, so a few
    candidates are judged by the labelers' presumed reliabilities and many by
    the estimated ones.  No labeler may come out worse than chance."""
    vote = np.array([digits_of(int(c)) for c in codes], np.int64).reshape(len(codes), LABELERS_EACH)
    right = np.array([TRUST[sort] for sort in LABELERS[kind]])
    prior = np.stack([1 - right, right], axis=1)
    yes, share = prior.copy(), PRIOR_YES / (PRIOR_YES + PRIOR_NO)
    p, base = np.zeros(len(codes)), vote[:, 0] == 2
    open_counts = np.where(base, 0.0, counts)
    for _ in range(rounds):
        weight = np.stack([np.log((1 - yes[:, 1]) / (1 - yes[:, 0])), np.zeros(LABELERS_EACH), np.log(yes[:, 1] / yes[:, 0])], axis=1)
        odds = math.log(share / (1 - share)) + weight[np.arange(LABELERS_EACH), vote].sum(1)
        new = np.where(base, 1.0, 1 / (1 + np.exp(-np.clip(odds, -50, 50))))
        done = np.abs(new - p).max(initial=0) < tolerance
        p = new
        if done:
            break
        share = (open_counts @ p + PRIOR_YES) / (open_counts.sum() + PRIOR_YES + PRIOR_NO)
        for y, of in ((0, counts * (1 - p)), (1, counts * p)):
            said, said_yes = of @ (vote != 1), of @ (vote == 2)
            yes[:, y] = (said_yes + PRIOR_WEIGHT * prior[:, y]) / (said + PRIOR_WEIGHT)
        wrong = yes[:, 0] > yes[:, 1]
        yes[wrong] = yes[wrong].mean(1)[:, None]
    return p, share, yes


def fit_classifier(rows: list[list[int]], target: np.ndarray, steps: int = 400, rate: float = 0.5, l2: float = 1e-4) -> dict:
    """Logistic regression of feature hashes on probabilities, by Adagrad."""
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows]) if rows else np.zeros(0, np.int64)
    known, col = np.unique(np.array([f for r in rows for f in r], np.int64), return_inverse=True)
    w, seen = np.zeros(len(known)), np.full(len(known), 1e-8)
    for _ in range(steps):
        z = np.bincount(row, weights=w[col], minlength=len(target))
        e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) / max(1, len(target))
        g = np.bincount(col, weights=e[row], minlength=len(known)) + l2 * w
        seen += g * g
        w -= rate * g / np.sqrt(seen)
    return dict(zip(known.tolist(), w.tolist(), strict=True))


def probability(model: dict, fs: list[int]) -> float:
    """Of a candidate by its features; an unknown feature weighs nothing."""
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(model.get(f, 0.0) for f in fs)))))


_SPAN = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                      T.StructField("base", T.BooleanType()), T.StructField("votes", T.IntegerType()), T.StructField("features", T.ArrayType(T.LongType()))])
SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                                  T.StructField("score", T.DoubleType()), T.StructField("base", T.BooleanType())]))


def voted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, found) of every document: its candidates with their
    votes and features."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    schema = T.StructType([T.StructField("doc_id", id_type(src)), T.StructField("found", T.ArrayType(_SPAN))])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        to = to_arrow_schema(schema)
        for batch in (x for whole in batches for x in slices(whole, "text")):
            texts = batch.column("text")
            found: list = [[]] * batch.num_rows
            for i in np.flatnonzero(pc.match_substring_regex(texts, WORTH).to_numpy(zero_copy_only=False)).tolist():
                text = texts[i].as_py()
                base = base_spans(text)
                own = set(base)
                found[i] = [(*s, s in own, votes(text, s, s in own), features(text, s)) for s in candidates(text, base)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, to.field("found").type)], schema=to)

    return src.mapInArrow(run, schema)


def fit(found: DataFrame, sample: int = SAMPLE) -> dict:
    """The span classifier, from all candidates' votes.  It is fitted on at
    most ``sample`` distinct (kind, votes, features), those whose hashes are
    smallest; without candidates it is empty."""
    each = found.select(F.explode("found").alias("c")).select("c.*")
    counts = each.groupBy("kind", "votes").count().collect()  # at most 4 x 3^5 rows
    learnt = {}
    for k, kind in enumerate(KINDS):
        rows = sorted((r.votes, r["count"]) for r in counts if r.kind == k)
        codes, n = np.array([v for v, _ in rows], np.int64), np.array([c for _, c in rows], float)
        p, _, _ = expectation_maximisation(kind, codes, n)
        learnt.update({(k, int(v)): float(x) for v, x in zip(codes, p, strict=True)})
    few = saved(each.select("kind", "votes", "features").distinct()
                .orderBy(F.xxhash64("kind", "votes", "features"), "kind", "votes", "features").limit(sample), "pii-sample")

    def run(batches):
        rows = sorted((r["kind"], r["votes"], r["features"]) for b in batches for r in b.to_pylist())
        if rows:
            model = fit_classifier([f for _, _, f in rows], np.array([learnt[k, v] for k, v, _ in rows]))
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    made = few.repartition(1).mapInArrow(run, "model binary").collect()  # at most ``sample`` rows of integers in the one task
    return pickle.loads(made[0].model) if made else {}


def decided(found: list[dict], model: dict, threshold: float = THRESHOLD) -> list[tuple]:
    """A document's spans, by kind and start: the base ones, and candidates of
    at least ``threshold`` that overlap neither those nor a likelier one."""
    out = [(c["kind"], c["start"], c["end"], probability(model, c["features"]), True) for c in found if c["base"]]
    free = _Free([(s, e) for _, s, e, _, _ in out])
    likely = [(c, p) for c in found if not c["base"] and (p := probability(model, c["features"])) >= threshold]
    for c, p in sorted(likely, key=lambda x: (-x[1], x[0]["start"], -x[0]["end"], x[0]["kind"])):
        if free(c["start"], c["end"]):
            out.append((c["kind"], c["start"], c["end"], p, False))
            free.add(c["start"], c["end"])
    return sorted(out)


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (doc_id, spans) of every document; a span has kind, start, end,
    the classifier's probability and whether it is a base one, in order of
    kind and start.

    A null or empty text has none; repeated rows have theirs each; an empty
    table gives no rows; a null id is kept."""
    found = saved(voted(docs, id_col, text_col), "pii-votes")
    model = fit(found, sample)
    schema = T.StructType([found.schema["doc_id"], T.StructField("spans", SPANS)])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        to = to_arrow_schema(schema)
        for batch in batches:
            column, out = batch.column("found"), [[]] * batch.num_rows
            for i in np.flatnonzero(pc.list_value_length(column).to_numpy(zero_copy_only=False)).tolist():
                out[i] = [(KINDS[k], *rest) for k, *rest in decided(column[i].as_py(), model, threshold)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, to.field("spans").type)], schema=to)

    return found.mapInArrow(run, schema)


def _joined(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(kind: str) -> F.Column:
    return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("bigint").alias(f"n_{kind}")


def op11_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = spans(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    return out.select("doc_id", *[_count(k) for k in KINDS], F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
