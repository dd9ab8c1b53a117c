import hashlib
import math
import random
import re

import numpy as np
from edge import LONG, ROWS, edge_docs, empty_docs, write_tables

from tallyhall.llm import pii

# The base patterns as the contract words them, without possessive runs.
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(d[::-1])) % 10 == 0


def base(text):
    out = []
    for k, kind in enumerate(PLAIN):
        for m in re.finditer(PLAIN[kind], text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                    "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]:
                out.append((k, *m.span()))
    return out


def sealed(digits):
    """The digits with a last one that makes the sum right."""
    return next(digits + c for c in "0123456789" if luhn(digits + c))


AWKWARD = ROWS + [
    (20, "a@b@c.de a.b@c..d x@y.z%w@u.v.w, mail me@localhost -@-.- .@a.b. 1@2.3"),
    (21, "1.2.3.4.5 256.1.1.1 1.1.1.256 001.0002.3.255 1.2.3. 1..2.3.4 9.9.9.9.9.9.9.9"),
    (22, "4111 1111 1111 1111, 4111-1111 1111-1111 7 4111111111111111 4111111111111112  5"),
    (23, "+1 (974) 555-3436 +12 +1234567 +1 2 3 4 5 6 7 8) +1(((((( ++49 30 1234567- +49.30.1234.5678 12"),
    (24, "é@ü.de ünï+1 23 45 67 89 🙂 me@mail.example.org 🙂 10.0.0.1"),
    (25, "7" * 3000 + " " + "a" * 3000 + "@" + "b" * 3000 + " " + "1." * 3000 + "@"), (26, "+1" + " " * 5000), (27, "1 " * 4000),
    (28, "0" * 5000 + ".1.1.1 " + "9" * 5000 + ".1.1.1"),
]


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(4)
    texts = [t or "" for _, t in AWKWARD[:-1]] + ["".join(rng.choice("a1.@ +-(9%") for _ in range(40)) for _ in range(4000)]
    for t in texts:
        assert pii.base_spans(t) == base(t), t
    assert pii.base_spans(AWKWARD[-1][1]) == [(1, 0, 5006)]


def test_very_long_runs_take_time_in_proportion():
    for text in ("a" * 2_000_000, "1" * 2_000_000, "1-" * 1_000_000, "a@" * 500_000, "+1" + "(" * 2_000_000, "1.1" * 700_000, "(at)" * 300_000):
        pii.candidates(text, pii.base_spans(text))


def test_equal_to_estimation_by_candidate():
    """The same model over single candidates instead of counted codes."""
    rng = random.Random(8)
    truth = [rng.random() < 0.3 for _ in range(3000)]
    codes = []
    for y in truth:
        vote = [rng.choices([0, 1, 2], (0.1, 0.3, 0.6) if y else (0.6, 0.3, 0.1))[0] for _ in range(5)]
        vote[0] = 2 if y and rng.random() < 0.4 else 1  # a base span is true
        codes.append(sum(v * 3 ** i for i, v in enumerate(reversed(vote))))
    known, n = np.unique(codes, return_counts=True)
    p, share, yes = pii.expectation_maximisation("phone", known, n.astype(float))
    votes = [pii.digits_of(c) for c in codes]
    of = dict(zip(known.tolist(), p.tolist()))
    # A fixed point: the expected shares give the tables, the tables the expectation.
    q = [of[c] for c in codes]
    rest = [x for x, v in zip(q, votes) if v[0] != 2]
    assert all(x == 1 for x, v in zip(q, votes) if v[0] == 2)
    assert math.isclose(share, (sum(rest) + pii.PRIOR_YES) / (len(rest) + pii.PRIOR_YES + pii.PRIOR_NO), abs_tol=1e-6)
    for j, sort in enumerate(pii.LABELERS["phone"]):
        said = [(x, v[j]) for x, v in zip(q, votes) if v[j] != 1]
        trust = pii.PRIOR_WEIGHT * pii.TRUST[sort]
        assert math.isclose(yes[j, 1], (sum(x for x, v in said if v == 2) + trust) / (sum(x for x, _ in said) + pii.PRIOR_WEIGHT), abs_tol=1e-6)
    for c, vote in list(zip(codes, votes))[:200]:
        odds = math.log(share / (1 - share))
        for j, v in enumerate(vote):
            odds += {0: math.log((1 - yes[j, 1]) / (1 - yes[j, 0])), 1: 0, 2: math.log(yes[j, 1] / yes[j, 0])}[v]
        assert vote[0] == 2 or math.isclose(of[c], 1 / (1 + math.exp(-odds)), abs_tol=1e-6)
    true = sum(y and v[0] != 2 for y, v in zip(truth, votes)) / len(rest)
    assert abs(share - true) < 0.03 and np.abs(yes[1:, 1] - 6 / 7).max() < 0.05 and np.abs(yes[1:, 0] - 1 / 7).max() < 0.05
    assert sum((of[c] > 0.5) == y for c, y in zip(codes, truth)) > 0.93 * len(truth)


def test_no_labeler_comes_out_worse_than_chance():
    codes = np.array([0, 242, 81, 161, 2, 240])
    for kind in pii.KINDS:
        p, _, yes = pii.expectation_maximisation(kind, codes, np.array([50.0, 1.0, 4000.0, 9.0, 900.0, 900.0]))
        assert (yes[:, 1] >= yes[:, 0] - 1e-9).all() and p[0] < 0.5 and p[1] == 1


def planted(n, seed):
    """Texts with spans beyond the base patterns, and look-alikes."""
    rng = random.Random(seed)
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    rows, want = [], {}
    for i in range(n):
        word = "".join(rng.choice("abcdefghij") for _ in range(6))
        kind, hidden = [
            ("phone", f"({digits(3)}) 555-{digits(4)}"), ("email", f"{word} [at] example [dot] com"),
            ("card", sealed("3714" + digits(10))), ("ip", f"2001:db8:{rng.randrange(4096):x}:1:2:3:4:{rng.randrange(4096):x}"),
            (None, f"{rng.randrange(1, 29):02}.{rng.randrange(1, 13):02}.19{digits(2)}"), (None, f"{digits(2)} {digits(3)} {digits(3)}"),
            (None, "6" + digits(15)), (None, f"{rng.randrange(10, 24)}:{rng.randrange(10, 60)}:{rng.randrange(10, 60)}"), (None, f"@{word} and {digits(8)}")][i % 9]
        lead = {"phone": "please call", "email": "write to", "card": "amex card", "ip": "server address"}.get(kind, "seen in")
        if kind is None and len(hidden) == 16 and luhn(hidden):
            hidden = hidden[:-1] + str((int(hidden[-1]) + 1) % 10)
        text = f"{word} {lead} {hidden} and more {word}"
        rows.append((i, text))
        want[i] = [(kind, text.index(hidden), text.index(hidden) + len(hidden))] if kind else []
    return rows, want


def test_planted_spans_are_found_and_look_alikes_left(spark):
    for n, seed in ((9, 1), (18, 2), (900, 3)):
        rows, want = planted(n, seed)
        rows += [(10_000 + i, f"word me{i}@mail.example.com or +1 (222) 555-{i:04}, 10.0.0.{i % 256} done") for i in range(n)]
        out = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.spans(edge_docs(spark, rows)).collect()}
        spans = [(i, s) for i in want for s in want[i]]
        assert sum(s in out[i] for i, s in spans) >= 0.9 * len(spans), (n, [(rows[i][1], out[i]) for i, s in spans if s not in out[i]])
        clean = [i for i in want if not want[i]]
        assert sum(not out[i] for i in clean) >= 0.95 * len(clean), (n, [(rows[i][1], out[i]) for i in clean if out[i]])
        assert all(len(out[10_000 + i]) == 3 for i in range(n))


def test_query_equals_brute_force_over_awkward_rows(spark, tmp_path):
    rows = AWKWARD[:-1] + [(30 + i, "same row me@mail.example.com") for i in range(40)] + [(29, LONG + "10.1.2.3 " + LONG)]
    got = sorted(map(tuple, pii.op11_weak_supervision_pii(spark, write_tables(tmp_path / "a", edge_docs(spark, rows))).collect()), key=str)
    assert len(got) == len(rows)
    wanted = []
    for key, text in rows:
        b = base(text)
        joined = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in b)
        wanted.append((key, *[sum(x[0] == k for x in b) for k in range(4)], hashlib.sha256(joined.encode()).hexdigest()))
    assert [r[:6] for r in got] == sorted(wanted, key=str)
    # The rest by one loop over all candidates.
    found = {}
    for key, text in rows:
        own = set(base(text))
        found[key, text] = [(s, s in own, pii.votes(text, s, s in own), pii.features(text, s)) for s in pii.candidates(text or "", sorted(own))]
    learnt = {}
    for k, kind in enumerate(pii.KINDS):
        codes = [v for c in rows for s, _, v, _ in found[c] if s[0] == k]
        known, n = np.unique(np.array(codes, np.int64), return_counts=True)
        learnt |= {(k, int(v)): x for v, x in zip(known, pii.expectation_maximisation(kind, known, n.astype(float))[0])}
    distinct = sorted({(s[0], v, tuple(f)) for c in rows for s, _, v, f in found[c]})
    model = pii.fit_classifier([list(f) for _, _, f in distinct], np.array([learnt[k, v] for k, v, _ in distinct]))
    spans = []
    for c in rows:
        kept = [s for s, own, _, _ in found[c] if own]
        for p, s in sorted((-pii.probability(model, f), s) for s, own, _, f in found[c] if not own):
            if -p >= 0.5 and all(s[2] <= a or b <= s[1] for _, a, b in kept):
                kept.append(s)
        spans.append((c[0], ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in sorted(kept))))
    assert sorted(((r[0], r[6]) for r in got), key=str) == sorted(spans, key=str)


def test_empty_table(spark, tmp_path):
    assert pii.op11_weak_supervision_pii(spark, write_tables(tmp_path / "b", empty_docs(spark))).count() == 0
