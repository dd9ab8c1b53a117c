"""Language-model scores by a hierarchical Pitman-Yor model of words.

Restaurants form a tree: one for each context (the word before, by its 64-bit
hash), over one for the shorter, empty context, over one of all words, over
the uniform distribution on the training words and one unknown word.  So
contexts grow in number with the corpus and share no counts.

Words are dealt to buckets by hash, so all restaurants' customers of one word
meet in one bucket, and so do the word's counts.  The contexts' numbers of
customers and tables are a table by ranges of the contexts' hashes: each
bucket adds up its own tables by context and asks for the totals of its
contexts, the sums are made for each range, and the answers are joined to the
bucket.  Only the numbers of the two upper restaurants come to the driver.

Seating is sampled by Gibbs: for each dish (word) of each restaurant the
number of its tables is drawn given all others, exactly for up to ``EXACT``
customers, and by seating customers in turn beyond (an eighth of those seated
at a time).  Tables are the parent restaurant's customers.  Within a job a
bucket sees the other buckets' tables as they were after the job before.
The scored probability is the mean over ``SAMPLES`` sampled seatings.

Words are named by 64-bit hashes.
"""

from __future__ import annotations

import gc
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bucket, id_type, partitions, removed, saved, scratch, table
from .features import hashed
from .tokens import slices

CHILDREN = 1 << 64  # contexts of a shorter one: all 64-bit hashes have the empty context as parent
SAMPLES, BURN_IN, EXACT, STRENGTH = 3, 1, 8, 1.0
SLICE_BYTES = 12 << 20
END = "\n"  # never a word


def _named(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash, context) of words: as a context a word is its hash, too."""
    h = hashed(words, "word")
    return h, h


@dataclass
class Tokens:
    """All tokens of a slice in order: word hash, context and row."""

    word: np.ndarray
    context: np.ndarray
    row: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array) -> Tokens:
        low = pc.ascii_lower(pc.fill_null(texts, ""))
        cut = pc.ascii_split_whitespace(low)
        named = pa.concat_arrays([cut.flatten(), pa.array([END, ""])]).dictionary_encode()
        h, context = _named(named.dictionary)
        numbers = named.indices.to_numpy()
        code, end, blank = numbers[:-2], numbers[-2], numbers[-1]
        row = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(cut.offsets.to_numpy()))
        keep = code != blank
        code, row = code[keep], row[keep]
        stops = np.searchsorted(row, np.arange(len(texts)), side="right")
        code, row = np.insert(code, stops, end), np.insert(row, stops, np.arange(len(texts), dtype=np.int32))
        before = np.concatenate([[end], code[:-1]]).astype(np.int32) if len(code) else code
        return cls(h[code], context[before], row)

    def only(self, keep: np.ndarray) -> Tokens:
        return Tokens(self.word[keep], self.context[keep], self.row[keep])


DELTAS = 1 << 8  # added to an item's width: differences of ascending values


def _planes(a: np.ndarray) -> bytes:
    """Items byte by byte, all lowest bytes first: alike bytes side by side."""
    a = np.ascontiguousarray(a)
    return a.tobytes() if a.itemsize == 1 else a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes()


def _zip(*arrays: np.ndarray) -> bytes:
    """Unsigned arrays, compressed: lengths, widths and planes of bytes.
    Ascending hashes are written as their differences."""
    head, planes = [], []
    for a in arrays:
        rising = a.dtype == np.uint64 and len(a) > 1 and bool((a[1:] >= a[:-1]).all())
        head += [len(a), a.itemsize + DELTAS * rising]
        planes.append(_planes(np.diff(a, prepend=np.uint64(0)) if rising else a))
    raw = b"".join([np.array([len(arrays)], "<i8").tobytes(), np.array(head, "<i8").tobytes(), *planes])
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd").compress(raw, asbytes=True)


def _unzip(body: bytes) -> list[np.ndarray]:
    """Unsigned arrays as _zip was given them."""
    raw = pa.Codec("zstd").decompress(body[8:], decompressed_size=int.from_bytes(body[:8], "little"), asbytes=True)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    head, at, out = np.frombuffer(raw, "<i8", 2 * n, 8), 8 + 16 * n, []
    for size, width in head.reshape(n, 2).tolist():
        rising, width = divmod(width, DELTAS)
        planes = np.frombuffer(raw, np.uint8, size * width, at)
        a = planes if width == 1 else np.ascontiguousarray(planes.reshape(width, size).T).view(f"<u{width}").reshape(size)
        out.append(np.cumsum(a, dtype=np.uint64) if rising else a)
        at += size * width
    return out


class _Steps:
    """Tables that a step writes and a later one reads; one that is no longer
    needed is removed, so the disk holds the last steps only."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def put(self, df: DataFrame, name: str, *apart: str) -> DataFrame:
        self.paths[name] = scratch(self.spark, name)
        df.write.option("compression", "zstd").partitionBy(*apart).parquet(self.paths[name])
        return self.spark.read.schema(df.schema).parquet(self.paths[name])

    def drop(self, *names: str) -> None:
        """Also lets Spark's cleaner remove the shuffles of written steps,
        which it does for what the collector has found unused."""
        for name in names:
            removed(self.spark, self.paths.pop(name))
        gc.collect()
        self.spark._jvm.System.gc()


def _runs(x: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal neighbours."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)


def _sizes(starts: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.concatenate([starts, [n]]))


def pair_counts(word: np.ndarray, context: np.ndarray, count: np.ndarray):
    """Distinct (word, context), sorted, with summed counts."""
    order = np.lexsort((context, word))
    word, context, count = word[order], context[order], count[order]
    starts = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (context[1:] != context[:-1])])) if len(word) else np.zeros(0, np.int64)
    return word[starts], context[starts], np.add.reduceat(count, starts) if len(starts) else count[:0]


def _narrow(x: np.ndarray) -> np.ndarray:
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if top < 256 else np.uint16 if top < 65536 else np.uint32 if top < 2**32 else np.uint64)


def _coded(x: np.ndarray) -> list[np.ndarray]:
    """Distinct values, sorted, and the number of each place's value."""
    values, at = np.unique(x, return_inverse=True)
    return [values, _narrow(at)]


def _dealt(word: np.ndarray, n: int):
    part = (word % np.uint64(n)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    starts = _runs(part[order])
    for a, size in zip(starts.tolist(), _sizes(starts, len(order)).tolist(), strict=True):
        yield int(part[order[a]]), order[a:a + size]


def _train_rows(batches, n_buckets: int):
    """Counts of a slice's training pairs, dealt to buckets."""
    for batch in (x for whole in batches for x in slices(whole, "text", SLICE_BYTES)):
        t = Tokens.of(batch.column("text"))
        t = t.only(pc.invert(batch.column("held_out")).to_numpy(zero_copy_only=False)[t.row])
        word, context, count = pair_counts(t.word, t.context, np.ones(len(t.word), np.int64))
        found = []
        for k, own in _dealt(word, n_buckets):
            starts = _runs(word[own])
            found.append((k, _zip(word[own][starts], _narrow(_sizes(starts, len(own))), *_coded(context[own]), _narrow(count[own]))))
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary())], ["bucket", "body"])


class Restaurants:
    """All customers of a bucket's words: pairs (word number, context number),
    words in the empty context, words of the root; ``tables`` at the three
    levels.  ``contexts`` are the pairs' distinct contexts, sorted."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray, contexts: np.ndarray, at: np.ndarray, count: np.ndarray):
        self.words, self.sizes, self.contexts = words, sizes, contexts
        self.at, self.count = at.astype(np.int64), count.astype(np.int64)
        self.of = np.repeat(np.arange(len(words), dtype=np.int64), sizes)
        self.key = self.of * len(contexts) + self.at
        self.kind_of, self.kind_class = np.arange(len(words)), np.zeros(len(words), np.int64)  # one shorter context
        self.total = np.bincount(self.of, weights=self.count, minlength=len(words)).astype(np.int64)
        self.tables = [np.ones(len(x), np.int64) for x in (self.key, words, words)]

    @property
    def context(self) -> np.ndarray:
        return self.contexts[self.at]

    def customers(self) -> list[np.ndarray]:
        return [self.count, np.bincount(self.of, weights=self.tables[0], minlength=len(self.words)).astype(np.int64), self.tables[1]]

    def by_context(self, x: np.ndarray) -> np.ndarray:
        """Sums of the pairs' numbers by context."""
        return np.bincount(self.at, weights=x, minlength=len(self.contexts)).astype(np.int64)

    def totals(self) -> np.ndarray:
        """Tables of all contexts, of the empty context and of the root."""
        return np.array([x.sum() for x in self.tables], np.int64)

    def body(self) -> list[np.ndarray]:
        return [self.words, _narrow(self.sizes), _narrow(self.at), _narrow(self.count)]


N_TOTALS = 3


@dataclass
class Prior:
    """Discounts by level (contexts, empty context, root), training tokens and
    distinct training words."""

    discount: tuple[float, float, float]
    tokens: int
    words: int


def root_probability(prior: Prior, totals: np.ndarray, customers, tables):
    """Of a word with those customers and tables at the root; zeros give the
    unknown word's."""
    d = prior.discount[2]
    return (customers - d * tables + (STRENGTH + d * totals[2]) / (prior.words + 1)) / (STRENGTH + totals[1])


def empty_probability(prior: Prior, totals: np.ndarray, customers, tables, parent):
    d = prior.discount[1]
    return (customers - d * tables + (STRENGTH + d * totals[1]) * parent) / (STRENGTH + totals[0])


def context_probability(prior: Prior, of_tokens, of_tables, own, parent):
    """In contexts with those tokens and tables, ``own`` being the dish's
    customers less its discounted tables."""
    return (own + (STRENGTH + prior.discount[0] * of_tables) * parent) / (STRENGTH + of_tokens)


def log_stirling(d: float, top: int = EXACT) -> np.ndarray:
    """Logs of the generalised Stirling numbers: seatings of c customers at t
    tables, by [c, t]."""
    s = np.zeros((top + 1, top + 1))
    s[0, 0] = 1
    for c in range(top):
        for t in range(1, c + 2):
            s[c + 1, t] = s[c, t - 1] + max(0.0, c - d * t) * s[c, t]
    with np.errstate(divide="ignore"):
        return np.log(s)


def draw_tables(rng: np.random.Generator, customers: np.ndarray, others: np.ndarray, parent: np.ndarray, d: float) -> np.ndarray:
    """The number of tables of each dish, given the restaurant's tables of
    other dishes and the dish's probability in the parent."""
    out = np.ones(len(customers), np.int64)
    stirling, others = log_stirling(d), np.maximum(others, 0)
    for c in range(2, EXACT + 1):
        at = np.flatnonzero(customers == c)
        if len(at):
            t = np.arange(c)
            grow = np.log((STRENGTH + d * (others[at, None] + t)) * parent[at, None])
            logits = np.cumsum(grow, axis=1) + stirling[c, 1:c + 1]
            p = np.cumsum(np.exp(logits - logits.max(axis=1, keepdims=True)), axis=1)
            out[at] = 1 + (rng.random(len(at))[:, None] * p[:, -1:] > p[:, :-1]).sum(axis=1)
    live = np.flatnonzero(customers > EXACT)
    seated = np.ones(len(live), np.int64)
    while len(live):
        step = np.minimum(np.maximum(1, seated // 8), customers[live] - seated)
        new = (STRENGTH + d * (others[live] + out[live])) * parent[live]
        out[live] += rng.binomial(step, new / (new + seated - d * out[live]))
        seated += step
        more = seated < customers[live]
        live, seated = live[more], seated[more]
    return out


def sweep(r: Restaurants, prior: Prior, of_contexts: np.ndarray, totals: np.ndarray, rng: np.random.Generator) -> None:
    """Draws all tables anew, contexts first; ``of_contexts`` and ``totals``
    count the tables of all buckets and are not changed."""
    _, kinds, roots = r.customers()
    p_root = root_probability(prior, totals, roots, r.tables[2])
    p_kind = empty_probability(prior, totals, kinds, r.tables[1], p_root)
    r.tables[0] = draw_tables(rng, r.count, of_contexts[r.at] - r.tables[0], p_kind[r.of], prior.discount[0])
    _, kinds, _ = r.customers()
    r.tables[1] = draw_tables(rng, kinds, totals[1] - r.tables[1], p_root, prior.discount[1])
    _, _, roots = r.customers()
    flat = np.full(len(r.words), 1 / (prior.words + 1))
    r.tables[2] = draw_tables(rng, roots, totals[2] - r.tables[2], flat, prior.discount[2])


def sweeps(r: Restaurants, prior: Prior, of_contexts: np.ndarray, totals: np.ndarray, rngs):
    """A sweep for each generator, yielding after each.  The bucket's own
    tables in the totals move with it; the others' stay as they were."""
    for rng in rngs:
        own, upper = r.by_context(r.tables[0]), r.totals()
        sweep(r, prior, of_contexts, totals, rng)
        of_contexts, totals = of_contexts + r.by_context(r.tables[0]) - own, totals + r.totals() - upper
        yield


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Numbers of the keys, len(keys) for a key that is not there."""
    at = np.searchsorted(keys, wanted)
    known = at < len(keys)
    known[known] = keys[at[known]] == wanted[known]
    return np.where(known, at, len(keys))


class Scorer:
    """Probabilities of tokens by a bucket's restaurants, averaged over the
    sampled seatings.  ``answered``: the tokens of the bucket's contexts, and
    their tables in each seating."""

    def __init__(self, r: Restaurants, seatings: list[list[np.ndarray]], prior: Prior, totals: list[np.ndarray], answered: list[np.ndarray]):
        self.r, self.prior, self.levels = r, prior, []
        self.of_contexts = [np.append(x, 0) for x in answered]
        for tables, total in zip(seatings, totals, strict=True):
            r.tables = tables
            _, kinds, roots = r.customers()
            root = np.append(root_probability(prior, total, roots, tables[2]), root_probability(prior, total, 0, 0))
            empty = empty_probability(prior, total, np.append(kinds, 0), np.append(tables[1], 0), root)
            self.levels.append((empty, np.append(r.count - prior.discount[0] * tables[0], 0)))

    def __call__(self, words: np.ndarray, sizes: np.ndarray, contexts: np.ndarray, code: np.ndarray):
        """(probability, training count, whether open, parent's probability
        by seating) of tokens, given as runs of words, their contexts by
        number.  Open tokens are those whose context is not in this bucket:
        their probability needs the context's totals and is given as 1."""
        number = np.repeat(_find(self.r.words, words), sizes)
        u = _find(self.r.contexts, contexts)[code]
        n = len(self.r.contexts)
        at = _find(self.r.key, np.where((u == n) | (number == len(self.r.words)), -1, number * n + u))
        is_open, parents = u == n, [empty[number] for empty, _ in self.levels]
        p = sum(context_probability(self.prior, self.of_contexts[0][u], tables[u], own[at], parent)
                for tables, (_, own), parent in zip(self.of_contexts[1:], self.levels, parents, strict=True)) / len(self.levels)
        return np.where(is_open, 1.0, p), np.append(self.r.total, 0)[number], is_open, [x[is_open] for x in parents]


def _restaurants(bodies: list[bytes]) -> Restaurants:
    """A bucket's restaurants from the slices' counts."""
    parts = [_unzip(b) for b in bodies]
    word = np.concatenate([np.repeat(w, n) for w, n, _, _, _ in parts])
    context = np.concatenate([c[at] for _, _, c, at, _ in parts])
    word, context, count = pair_counts(word, context, np.concatenate([x.astype(np.int64) for *_, x in parts]))
    starts = _runs(word)
    return Restaurants(word[starts], _sizes(starts, len(word)), *_coded(context), count)


# Rows of a bucket: its restaurants (at STATE), its tables (at TABLES), and
# questions or answers about contexts (at the number of their range).
ROWS = "bucket int, at int, body binary, totals binary"
STATE, TABLES = -1, -2


def _row(number: int, at: int, body: bytes, totals: np.ndarray | None = None) -> dict:
    return {"bucket": number, "at": at, "body": body, "totals": b"" if totals is None else _vector(totals)}


def _rows(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, pa.schema([("bucket", pa.int32()), ("at", pa.int32()), ("body", pa.binary()), ("totals", pa.binary())]))


def _place(contexts: np.ndarray, n: int) -> np.ndarray:
    """The ranges of contexts' hashes, one of ``n`` of even width."""
    return (((contexts >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def _questions(number: int, r: Restaurants, sums: list[np.ndarray], n: int) -> list[dict]:
    """A bucket's contexts and its sums by context, a row for each range."""
    place, out = _place(r.contexts, n), []
    starts = _runs(place)
    for a, size in zip(starts.tolist(), _sizes(starts, len(place)).tolist(), strict=True):
        out.append(_row(number, int(place[a]), _zip(r.contexts[a:a + size], *[_narrow(x[a:a + size]) for x in sums])))
    return out


def _answers(asked: DataFrame, keep: bool = False) -> DataFrame:
    """For each question a row of the same bucket and range with the totals of
    its contexts over all buckets; with ``keep`` also a row of bucket -1 for
    each range: its contexts and their totals."""

    def run(key, group):
        parts = [_unzip(b.as_py()) for b in group.column("body")]
        contexts, at = np.unique(np.concatenate([x[0] for x in parts]), return_inverse=True)
        sums = [np.bincount(at, weights=np.concatenate(x), minlength=len(contexts)).astype(np.int64)
                for x in zip(*[x[1:] for x in parts], strict=True)]
        place = key[0].as_py()
        rows = [_row(-1, place, _zip(contexts, *map(_narrow, sums)))] if keep else []
        stops = np.cumsum([len(x[0]) for x in parts])
        for number, own in zip(group.column("bucket").to_pylist(), np.split(at, stops[:-1]), strict=True):
            rows.append(_row(number, place, _zip(*[_narrow(x[own]) for x in sums])))
        return _rows(rows)

    return asked.groupBy("at").applyInArrow(run, ROWS)


def _met(group: pa.Table) -> tuple[bytes | None, bytes | None, list[np.ndarray]]:
    """Of a bucket's rows: the restaurants, the tables, and the answers on all
    its contexts in order."""
    found = sorted(zip(group.column("at").to_pylist(), group.column("body").to_pylist(), strict=True), key=lambda x: x[0])
    one = dict(x for x in found if x[0] < 0)
    answered = [_unzip(b) for at, b in found if at >= 0]
    return one.get(STATE), one.get(TABLES), [np.concatenate(x).astype(np.int64) for x in zip(*answered, strict=True)]


def _first_state(group: pa.Table) -> pa.Table:
    r = _restaurants(group.column("body").to_pylist())
    ones = [x for c in r.customers() for x in ((c == 1).sum(), (c == 2).sum())]
    totals = np.concatenate([r.totals(), ones, [r.count.sum(), len(r.words)]]).astype(np.int64)
    return _rows([_row(group.column("bucket")[0].as_py(), STATE, _zip(*r.body(), r.contexts), totals)])


FAN_IN = 8


def _vector(x: np.ndarray) -> bytes:
    """Counts, compressed: a file may hold many buckets' rows."""
    return _zip(_narrow(x))


def _counts(body: bytes) -> np.ndarray:
    return _unzip(body)[0].astype(np.int64)


def _summed(states: DataFrame, n_buckets: int, n: int) -> np.ndarray:
    """Sum of the buckets' vectors of ``n`` numbers, ``FAN_IN`` at a time; at
    most that many come to the driver."""

    def add(key, group):
        total = sum((_counts(x.as_py()) for x in group.column("totals")), np.zeros(n, np.int64))
        return pa.table({"at": pa.array([key[0].as_py()], pa.int64()), "totals": pa.array([_vector(total)], pa.binary())})

    vectors = states.where("length(totals) > 0").select(F.col("bucket").cast("bigint").alias("at"), "totals")
    while n_buckets > FAN_IN:
        vectors = vectors.withColumn("at", F.floor(F.col("at") / FAN_IN)).groupBy("at").applyInArrow(add, "at bigint, totals binary")
        n_buckets = -(-n_buckets // FAN_IN)
    return sum((_counts(r.totals) for r in vectors.select("totals").collect()), np.zeros(n, np.int64))


@dataclass
class Model:
    """``states``: a row for each bucket or share of a hot word (body: words,
    pairs, counts, the sampled tables and the contexts).  ``contexts``: for
    each of them the totals of its contexts, and all contexts by range (bucket
    -1): tokens, and tables by seating."""

    states: DataFrame
    contexts: DataFrame
    prior: Prior
    totals: list[np.ndarray]
    n_buckets: int
    hot: dict[int, tuple[int, int]]  # word -> (first extra bucket, how many)


def _load(body: bytes) -> Restaurants:
    arrays = _unzip(body)
    words, sizes, at, count = arrays[:4]
    return Restaurants(words, sizes.astype(np.int64), arrays[-1], at, count)


def train(tokens_of: DataFrame, seed: int = 1) -> Model:
    """The model of the rows of ``tokens_of`` (text, held_out) that are not
    held out.  No training rows give the uniform distribution on one word."""
    spark = tokens_of.sparkSession
    n = partitions(spark)
    counted = tokens_of.select("text", "held_out").mapInArrow(lambda b: _train_rows(b, n), "bucket int, body binary")
    steps = _Steps(spark)
    state = steps.put(counted.groupBy("bucket").applyInArrow(_first_state, ROWS), "restaurants")
    steps.drop()
    first = _summed(state, n, N_TOTALS + 8)
    ones, (n_tokens, n_words) = first[N_TOTALS:N_TOTALS + 6].reshape(3, 2), first[N_TOTALS + 6:].tolist()
    discount = tuple(float(np.clip(a / max(1, a + 2 * b), 0.05, 0.95)) for a, b in ones)
    prior = Prior(discount, n_tokens, n_words)
    start, burn_in, samples = first[:N_TOTALS], BURN_IN, SAMPLES

    def ask(batches):
        for batch in batches:
            for row in batch.to_pylist():
                r = _load(row["body"])
                yield from _rows(_questions(row["bucket"], r, [r.by_context(r.tables[0])], n)).to_batches()

    def burn(key, group):
        number, (body, _, answered) = key[0].as_py(), _met(group)
        r = _load(body)
        for _ in sweeps(r, prior, answered[0], start, [np.random.default_rng([seed, 0, i, number]) for i in range(burn_in)]):
            pass
        return _rows([_row(number, TABLES, _zip(*map(_narrow, r.tables)), r.totals()),
                      *_questions(number, r, [r.by_context(r.tables[0])], n)])

    opened = steps.put(_answers(state.mapInArrow(ask, ROWS)), "first-contexts")
    steps.drop()
    burnt = steps.put(state.union(opened).groupBy("bucket").applyInArrow(burn, ROWS), "burn-in")
    steps.drop("first-contexts")
    warm = _summed(burnt, n, N_TOTALS)
    share = max(1, n_tokens) / (2 * n)
    # Words with more than half a bucket's even share: fewer than 2 n of them.
    big = _big_words(state, share)
    hot, extra = {}, n
    for word, count in sorted(big):
        hot[word] = (extra, int(np.ceil(count / share)))
        extra += hot[word][1]

    def sample(key, group):
        number, (body, tables, answered) = key[0].as_py(), _met(group)
        r = _load(body)
        r.tables = [x.astype(np.int64) for x in _unzip(tables)]
        seatings, totals = [], []
        for _ in sweeps(r, prior, answered[0], warm, [np.random.default_rng([seed, 1, i, number]) for i in range(samples)]):
            seatings.append(r.tables)
            r.tables = list(r.tables)
            totals.append(r.totals())
        own = np.array([int(w) not in hot for w in r.words], bool)
        parts = [(number, own, np.concatenate(totals), True)]
        for j in np.flatnonzero(~own).tolist():
            one = np.zeros(len(own), bool)
            one[j] = True
            at, k = hot[int(r.words[j])]
            parts += [(at + i, one, None, i == 0) for i in range(k)]
        rows = []
        for k, mine, vector, counts in parts:
            pairs = mine[r.of]
            part = Restaurants(r.words[mine], r.sizes[mine], *_coded(r.context[pairs]), r.count[pairs])
            sampled = [[x[m] for x, m in zip(t, (pairs, mine, mine), strict=True)] for t in seatings]
            rows.append(_row(k, STATE, _zip(*part.body(), *[_narrow(x) for t in sampled for x in t], part.contexts), vector))
            # Shares of a word ask alike, and the first one's tables count.
            rows += _questions(k, part, [part.by_context(x * counts) for x in (part.count, *[t[0] for t in sampled])], n)
        return _rows(rows)

    tables, asked = burnt.where(F.col("at") == TABLES), burnt.where("at >= 0")
    warm_contexts = steps.put(_answers(asked), "warm-contexts")
    steps.drop()
    # Questions stand in a folder of their own, which goes when they are answered.
    seated = steps.put(state.union(tables).union(warm_contexts).groupBy("bucket").applyInArrow(sample, ROWS)
                       .withColumn("asks", F.col("at") >= 0), "seatings", "asks")
    steps.drop("restaurants", "burn-in", "warm-contexts")
    totals = _summed(seated.where("not asks"), n, samples * N_TOTALS).reshape(samples, N_TOTALS)
    contexts = steps.put(_answers(seated.where("asks").drop("asks"), keep=True), "contexts")
    removed(spark, f"{steps.paths['seatings']}/asks=true")
    steps.drop()
    return Model(seated.where("not asks").select("bucket", "body"), contexts, prior, list(totals), n, hot)


def _big_words(state: DataFrame, least: float) -> list[tuple[int, int]]:
    def run(batches):
        for batch in batches:
            for body in batch.column("body").to_pylist():
                r = _load(body)
                at = r.total > least
                yield pa.RecordBatch.from_arrays([pa.array(r.words[at].view(np.int64)), pa.array(r.total[at])], ["word", "n"])

    return [(int(np.int64(r.word).view(np.uint64)), r.n) for r in state.select("body").mapInArrow(run, "word bigint, n bigint").collect()]


def _scorer(body: bytes | None, answered: list[np.ndarray], prior: Prior, totals: list[np.ndarray]) -> Scorer:
    if body is None:
        none = np.zeros(0, np.int64)
        no_words = np.zeros(0, np.uint64)
        return Scorer(Restaurants(no_words, none, no_words, none, none), [[none] * 3 for _ in totals], prior, totals, [none] * (1 + len(totals)))
    arrays = [x.astype(np.int64) for x in _unzip(body)[4:-1]]
    return Scorer(_load(body), [arrays[3 * i:3 * i + 3] for i in range(len(totals))], prior, totals, answered)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score) of ``docs`` (doc_id, text, held_out).

    Tokens go to their word's bucket by the slice of documents; a word with a
    large share of all tokens goes to one of several by slice.  A bucket sums
    its part of each document, and the parts are summed by slice.  Tokens in a
    context that their bucket has not met go on to the context's range, with
    the probabilities in the empty context.  Repeated
    rows are scored each; an empty table gives no rows."""
    n, prior, totals, hot = model.n_buckets, model.prior, model.totals, model.hot
    hot_words = np.array(sorted(hot), np.uint64)
    kind = id_type(docs)
    dealt_schema = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("slice", T.LongType()),
                                 T.StructField("body", T.BinaryType()), T.StructField("ids", T.ArrayType(kind))])
    part_schema = T.StructType([T.StructField("at", T.IntegerType()), *[f for f in dealt_schema.fields if f.name != "bucket"]])
    from pyspark.sql.pandas.types import to_arrow_type

    pa_ids = pa.list_(to_arrow_type(kind))

    def deal(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in (x for whole in batches for x in slices(whole, "text", SLICE_BYTES)):
            t = Tokens.of(batch.column("text"))
            order = np.lexsort((t.context, t.word))
            t = t.only(order)
            rows, bodies, ids = [], [], []
            at_hot = np.zeros(len(t.word), bool)
            if len(hot_words):
                at = np.minimum(np.searchsorted(hot_words, t.word), len(hot_words) - 1)
                at_hot = hot_words[at] == t.word
            groups = [(k, np.flatnonzero(~at_hot)[own]) for k, own in _dealt(t.word[~at_hot], n)]
            for w in np.unique(t.word[at_hot]).tolist():
                first, many = hot[w]
                groups.append((first + number % many, np.flatnonzero(t.word == np.uint64(w))))
            for k, own in groups:
                starts = _runs(t.word[own])
                rows.append(k)
                bodies.append(_zip(t.word[own][starts], _narrow(_sizes(starts, len(own))), *_coded(t.context[own]), _narrow(t.row[own])))
                ids.append(None)
            held = batch.column("held_out").to_numpy(zero_copy_only=False)
            rows.append(-1 - number % n)
            bodies.append(_zip(held.astype(np.uint8), np.bincount(t.row, minlength=len(batch)).astype(np.uint32)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int32()), pa.array([number] * len(rows), pa.int64()), pa.array(bodies, pa.binary()),
                 pa.concat_arrays([pa.array(ids, pa_ids), pa.ListArray.from_arrays([0, len(batch)], batch.column("doc_id")).cast(pa_ids)])],
                dealt_schema.names)
            number += 1

    def summed(row: np.ndarray, p: np.ndarray, base: np.ndarray, known: np.ndarray) -> bytes:
        docs_of, at = np.unique(row, return_inverse=True)
        return _zip(docs_of, np.bincount(at, weights=np.log10(p)).view(np.uint64), np.bincount(at, weights=base).view(np.uint64),
                    _narrow(np.bincount(at, weights=known).astype(np.int64)))

    def part(key, seats: pa.Table, dealt: pa.Table) -> pa.Table:
        dealt = dealt.drop_columns(["bucket"])
        if not dealt.num_rows or key[0].as_py() < 0:
            return dealt.add_column(0, "at", pa.array([-1] * dealt.num_rows, pa.int32()))
        state, _, answered = _met(seats)
        scorer = _scorer(state, answered, prior, totals)
        places, numbers, out = [], [], []
        for number, body in zip(dealt.column("slice").to_pylist(), dealt.column("body"), strict=True):
            words, sizes, contexts, code, row = _unzip(body.as_py())
            p, count, is_open, parents = scorer(words, sizes, contexts, code)
            places.append(-1)
            out.append(summed(row, p, np.log10((count + 1) / (prior.tokens + prior.words + 1)), count > 0))
            context, row = contexts[code[is_open]], row[is_open]
            place = _place(context, n)
            for k in np.unique(place).tolist():
                own = place == k
                places.append(k)
                out.append(_zip(context[own], row[own], *[x[own].view(np.uint64) for x in parents]))
            numbers += [number] * (len(out) - len(numbers))
        return pa.table([pa.array(places, pa.int32()), pa.array(numbers, pa.int64()), pa.array(out, pa.binary()), pa.nulls(len(out), pa_ids)],
                        part_schema.names)

    def closed(key, known: pa.Table, rows: pa.Table) -> pa.Table:
        """Parts of the open tokens, by their contexts' totals."""
        met = [x.astype(np.int64) if i else x for i, x in enumerate(_unzip(known.column("body")[0].as_py()))] if known.num_rows else [
            np.zeros(0, np.uint64 if not i else np.int64) for i in range(2 + len(totals))]
        of_contexts, out = [np.append(x, 0) for x in met[1:]], []
        for body in rows.column("body"):
            context, row, *parents = _unzip(body.as_py())
            u = _find(met[0], context)
            p = sum(context_probability(prior, of_contexts[0][u], tables[u], 0, parent.view(np.float64))
                    for tables, parent in zip(of_contexts[1:], parents, strict=True)) / len(parents)
            out.append(summed(row, p, np.zeros(len(p)), np.zeros(len(p))))
        return pa.table([pa.array([-1] * len(out), pa.int32()), rows.column("slice"), pa.array(out, pa.binary()), pa.nulls(len(out), pa_ids)],
                        part_schema.names)

    result = T.StructType([T.StructField("doc_id", kind), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("n_known", T.LongType()), T.StructField("train_tokens", T.LongType()),
                           T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])

    def whole(group: pa.Table) -> pa.Table:
        group = group.sort_by([("body", "ascending")])  # sums in one order
        about = next(i for i in range(group.num_rows) if group.column("ids")[i].is_valid)
        ids = group.column("ids")[about].values
        held, n_tokens = _unzip(group.column("body")[about].as_py())
        base, own, known = np.zeros(len(ids)), np.zeros(len(ids)), np.zeros(len(ids), np.int64)
        for i, body in enumerate(group.column("body")):
            if i != about:
                at, s, b, k = _unzip(body.as_py())
                own[at] += s.view(np.float64)
                base[at] += b.view(np.float64)
                known[at] += k.astype(np.int64)
        return pa.table([ids, pa.array(held.astype(bool)), pa.array(n_tokens.astype(np.int64)), pa.array(known),
                         pa.array(np.full(len(ids), prior.tokens)), pa.array(base), pa.array(own)], result.names)

    dealt = docs.select("doc_id", "text", "held_out").mapInArrow(deal, dealt_schema)
    seats = model.states.select("bucket", F.lit(STATE).alias("at"), "body").union(
        model.contexts.where("bucket >= 0").select("bucket", "at", "body"))
    parts = saved(seats.groupBy("bucket").cogroup(dealt.groupBy("bucket")).applyInArrow(part, part_schema), "parts")
    by_range = model.contexts.where("bucket = -1").select("at", "body")
    rest = by_range.groupBy("at").cogroup(parts.where("at >= 0").groupBy("at")).applyInArrow(closed, part_schema)
    return parts.where("at < 0").union(rest).drop("at").groupBy("slice").applyInArrow(whole, result)


def split(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 7, held: int = 2) -> DataFrame:
    """doc_id, text and held_out: whether crc32 of the id as text has that
    remainder (a null id: never).  A null text is empty: its end is its only
    token."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       (F.col(id_col).isNotNull() & (bucket(id_col, modulus) == held)).alias("held_out"))


def op1_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = split(table(spark, sf_dir, "documents"))
    return score(docs, train(docs))
