"""Secret scans: fixed patterns and a battery of randomness tests.

Besides the spans of three patterns, every run of 20 or more key characters
with a digit, or with letters of both cases, is a candidate.  Its encoding is
inferred (decimal, hex, base32, letters and digits of one case, letters of
both, base64) and
tested for what a random string of that encoding shows: uniform use of the
alphabet (chi-squared over groups of common, middling and rare letters of
each case and the other characters), runs (changes between kinds of
characters, and between vowels and others), the share of vowels (a part of
the alphabet that words overuse), and no serial correlation of code values.
Fisher's method combines the tests into one p-value; a random string is
refuted at c with a chance of about c.

False discoveries are controlled by length.  The null comes from the corpus:
each document with a candidate gives ``DECOYS`` strings of its own letters
and digits outside its candidates, in their order and of the candidate's
length, and they are put to the same tests.  In each length stratum a cutoff
c may be used if tested x (decoys that pass c + 1) / (decoys + 1) is at most
``fdr`` of the candidates that pass c, which is the Benjamini-Hochberg rule
for p-values against the decoys; the lowest such cutoff is taken, of
``CUTOFFS``, whose first is the battery's own size.  The rule is the same for
one candidate and for any number.  Equal candidates of a stratum count once,
however many documents hold them, and so do the decoys of equal texts.

Only DataFrame and SQL functions run here.  Positions are code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import saved, table

# The base patterns and the order of kinds.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
CUTOFFS = (0.01, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.75)
FDR = 0.05
DECOYS, DECOY_LENGTH = 48, 512  # for each document; longer candidates are compared with decoys of that length

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


COMMON = ("etaoinsr", "hldcumfp", "gwybvkxjqz")  # letters by how often words use them
VOWELS = "aeiou"


def _key(id_col: str, text_col: str) -> Column:
    """128 bits of hash of a row's id and text."""
    text = F.col(text_col).cast("string")
    return F.struct(F.xxhash64(F.col(id_col), text).alias("a"), F.xxhash64(text, F.col(id_col), F.lit(1)).alias("b"))


def _matches(flagged: DataFrame, kind: str, pattern: str, group: int = 0) -> DataFrame:
    """Rows (doc_key, kind, start, stop, value) of the pattern's matches,
    leftmost and not overlapping.  A match starts after the gaps and matches
    before it; the sum runs within one document."""
    zipped = F.arrays_zip(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("found"),
                          F.regexp_extract_all("text", F.lit(pattern), F.lit(group)).alias("value"),
                          F.split("text", pattern, -1).alias("gap"))
    rows = flagged.where(F.col("text").rlike(pattern)).select("doc_key", F.posexplode(zipped).alias("i", "m"))
    w = Window.partitionBy("doc_key").orderBy("i")
    stop = F.sum(F.length("m.gap") + F.coalesce(F.length("m.found"), F.lit(0))).over(w)
    rows = rows.select("doc_key", "i", "m", stop.alias("stop")).where("m.found is not null")
    return rows.select("doc_key", F.lit(kind).alias("kind"), (F.col("stop") - F.length("m.found")).alias("start"), "stop",
                       F.col("m.value").alias("value"))


# The inferred encodings: alphabet, groups of the chi-squared test, kinds of the runs test, vowels.
_LOW, _UP = list(COMMON), [g.upper() for g in COMMON]
ENCODINGS = (
    (DIGITS, (DIGITS[:5], DIGITS[5:]), (DIGITS[:5], DIGITS[5:]), ""),
    (DIGITS + LOWER[:6], ((DIGITS + LOWER[:6])[:8], (DIGITS + LOWER[:6])[8:]), (DIGITS, LOWER[:6]), ""),
    (UPPER + DIGITS[2:8], (*_UP, DIGITS[2:8]), (UPPER, DIGITS[2:8]), VOWELS.upper()),
    (DIGITS + LOWER, (*_LOW, DIGITS), (LOWER, DIGITS), VOWELS),
    (UPPER + LOWER + DIGITS + "+/", (*_LOW, *_UP, DIGITS + "+/"), (LOWER, UPPER, DIGITS + "+/"), VOWELS + VOWELS.upper()),
    (UPPER + LOWER, (*_LOW, *_UP), (LOWER, UPPER), VOWELS + VOWELS.upper()))


def _of(chars: str) -> str:
    return f"(_n0 - length(translate(_s, '{chars}', '')))"


def _by_encoding(make) -> Column:
    out = None
    for i, e in enumerate(ENCODINGS):
        value = F.expr(make(*e))
        out = F.when(F.col("_e") == i, value) if out is None else out.when(F.col("_e") == i, value)
    return out


def _changes(z: str, kinds: tuple[str, ...], size: int) -> str:
    """The normal score of the changes between neighbours of unlike kind."""
    p = [len(k) / size for k in kinds]
    two, three = sum(x * x for x in p), sum(x ** 3 for x in p)
    q, tied = 1 - two, (1 - 2 * two + three) - (1 - two) ** 2
    letters = "".join(chr(ord("a") + i) * len(k) for i, k in enumerate(kinds))
    turns = f"(length(regexp_replace(translate({z}, '{''.join(kinds)}', '{letters}'), '(.)\\\\1*+', '-')) - 1)"
    return f"({turns} - (_n - 1) * {q!r}D) / sqrt(greatest((_n - 1) * {q * (1 - q)!r}D + 2 * (_n - 2) * {tied!r}D, 1e-9D))"


def _battery(df: DataFrame, token: str, out: str) -> DataFrame:
    """Adds ``out``: the combined p-value of the tests on column ``token``."""
    encoding = (F.when(F.col(token).rlike("^[0-9]+$"), 0).when(F.col(token).rlike("^([0-9a-f]+|[0-9A-F]+)$"), 1)
                .when(F.col(token).rlike("^[A-Z2-7]+=*$"), 2).when(F.col(token).rlike("^([0-9a-z]+|[0-9A-Z]+)$"), 3)
                .when(F.col(token).rlike("^[A-Za-z]+$"), 5).otherwise(4))
    body = F.rtrim(F.translate(token, "-_", "+/"), F.lit("="))
    t = df.withColumn("_e", encoding).withColumn("_s", F.when(F.col("_e").isin(2, 4), body)
                                                        .when(F.col("_e") == 5, F.col(token)).otherwise(F.lower(F.col(token))))
    t = t.withColumn("_n0", F.length("_s")).withColumn("_n", F.greatest("_n0", F.lit(2)).cast("double"))
    t = t.withColumn("_chi", _by_encoding(lambda a, groups, *_: " + ".join(
        f"power({_of(g)} - _n * {len(g) / len(a)!r}D, 2) / (_n * {len(g) / len(a)!r}D)" for g in groups)))
    t = t.withColumn("_df", _by_encoding(lambda a, groups, *_: f"{len(groups) - 1}D"))
    t = t.withColumn("_z1", F.expr("(power(_chi / _df, 1D / 3) - (1 - 2 / (9 * _df))) / sqrt(2 / (9 * _df))"))
    t = t.withColumn("_z2", _by_encoding(lambda a, groups, kinds, _: _changes("_s", kinds, len(a))))
    t = t.withColumn("_c", _by_encoding(lambda a, *_: f"transform(filter(split(_s, ''), c -> c <> ''), c -> cast(locate(c, '{a}') - 1 as double))"))
    t = t.withColumn("_m", F.expr("aggregate(_c, 0D, (a, c) -> a + c) / _n"))
    t = t.withColumn("_square", F.expr("aggregate(_c, 0D, (a, c) -> a + (c - _m) * (c - _m))"))
    t = t.withColumn("_lag", F.expr("""aggregate(sequence(1, greatest(size(_c) - 1, 1)), 0D, (a, i) ->
        a + coalesce((get(_c, i) - _m) * (get(_c, i - 1) - _m), 0D))"""))
    t = t.withColumn("_z3", F.expr("if(_square > 0, _lag / _square, 1D) * sqrt(_n)"))

    def others(a: str, vowels: str) -> str:
        return "".join(x for x in a if x not in vowels)

    t = t.withColumn("_z4", _by_encoding(lambda a, groups, kinds, v: _changes("_s", (v, others(a, v)), len(a)) if v else "0D"))
    t = t.withColumn("_z5", _by_encoding(lambda a, groups, kinds, v: f"({_of(v)} - _n * {len(v) / len(a)!r}D) / "
                                         f"sqrt(_n * {len(v) / len(a) * (1 - len(v) / len(a))!r}D)" if v else "0D"))

    def tail(z: str) -> str:  # the normal upper tail, by its logistic approximation
        return f"1 / (1 + exp(1.5976 * least({z}, 8D) + 0.070566 * power(least({z}, 8D), 3)))"

    t = t.withColumn("_x3", F.expr(f"-ln({tail('greatest(_z1, -8D)')}) - ln(2 * {tail('abs(_z2)')}) - ln(2 * {tail('abs(_z3)')})"))
    t = t.withColumn("_x5", F.expr(f"_x3 - ln(2 * {tail('abs(_z4)')}) - ln({tail('greatest(_z5, -8D)')})"))
    t = t.withColumn(out, F.expr("""if(_e < 2, exp(-_x3) * (1 + _x3 + _x3 * _x3 / 2),
        exp(-_x5) * (1 + _x5 + power(_x5, 2) / 2 + power(_x5, 3) / 6 + power(_x5, 4) / 24))"""))
    return t.drop(*[c for c in t.columns if c.startswith("_")])


def _stratum(length: Column) -> Column:
    return F.least(F.floor(F.log2(length / 16)), F.lit(3))


def _decoys(flagged: DataFrame) -> DataFrame:
    """Rows (doc_key, decoys): of each document ``DECOYS`` strings of its
    letters and digits outside candidates, from places evenly apart; its end
    goes on with its beginning.  Bounded, whatever the text."""
    t = flagged.select("doc_key", F.regexp_replace(F.regexp_replace("text", CANDIDATE, " "), "[^A-Za-z0-9]+", "").alias("own"))
    # Written first: Spark would else clean the text anew for each of the strings.
    t = saved(t, "own-letters").withColumn("own", F.when(F.col("own") == "", "a").otherwise(F.col("own")))
    ring = F.rpad(F.substring("own", 1, DECOY_LENGTH), DECOY_LENGTH, F.substring("own", 1, DECOY_LENGTH))
    starts = [F.floor(F.length("own") * (j / DECOYS)).cast("int") for j in range(DECOYS)]
    return t.select("doc_key", F.array(*[F.rpad(F.substr("own", s + 1, F.lit(DECOY_LENGTH)), F.lit(DECOY_LENGTH), ring) for s in starts]).alias("decoys"))


def _random(flagged: DataFrame, base: DataFrame, fdr: float) -> DataFrame:
    """Candidates that pass, as rows (doc_key, kind, start, stop); those that
    overlap a base span are left out."""
    value = F.col("value")
    found = _matches(flagged, "random", CANDIDATE).where(value.rlike("[0-9]") | (value.rlike("[a-z]") & value.rlike("[A-Z]")))
    taken = base.groupBy("doc_key").agg(F.collect_list(F.struct("start", "stop")).alias("taken"))  # one document's spans
    free = found.join(taken, "doc_key", "left").where(
        F.expr("not coalesce(exists(taken, t -> t.start < stop and start < t.stop), false)"))
    free = free.select("doc_key", "kind", "start", "stop", "value", _stratum(F.length("value")).alias("stratum"), F.xxhash64("value").alias("one"))
    tried = saved(_battery(free, "value", "p").drop("value"), "randomness")
    lengths = tried.select("doc_key", "stratum", F.least(F.col("stop") - F.col("start"), F.lit(DECOY_LENGTH)).cast("int").alias("n")).distinct()
    # Documents with the same text around their candidates count once.
    texts = lengths.join(_decoys(flagged), "doc_key").select("stratum", "n", "decoys").distinct()
    against = texts.select("stratum", F.explode("decoys").alias("whole"), "n").select("stratum", F.substr("whole", F.lit(1), F.col("n")).alias("decoy"))
    best = _cutoffs(tried.select("stratum", "one", "p").dropDuplicates(["stratum", "one"]), saved(_battery(against, "decoy", "p"), "decoys"), fdr)
    return tried.join(F.broadcast(best), "stratum").where("p >= cutoff").select("doc_key", "kind", "start", "stop")  # 4 strata


def _cutoffs(tried: DataFrame, decoys: DataFrame, fdr: float) -> DataFrame:
    """Rows (stratum, cutoff) of the strata that have one, from the distinct
    candidates and the decoys (stratum, p)."""
    def passing(df: DataFrame, all_of: str, each: str) -> DataFrame:
        return df.groupBy("stratum").agg(F.count("*").alias(all_of), *[F.count_if(F.col("p") >= c).alias(f"{each}{i}") for i, c in enumerate(CUTOFFS)])

    per = passing(tried, "tested", "passed").join(passing(decoys, "made", "fell"), "stratum")  # 4 rows each
    fits = [F.when(F.col("tested") * (F.col(f"fell{i}") + 1) / (F.col("made") + 1) <= fdr * F.col(f"passed{i}"), F.lit(c)) for i, c in enumerate(CUTOFFS)]
    return per.select("stratum", F.coalesce(*fits).alias("cutoff")).where("cutoff is not null")


def spans(docs: DataFrame, fdr: float = FDR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_key, kind, start, stop) of every secret; ``doc_key`` is
    two hashes of id and text, so repeated rows share theirs.

    Null and empty texts have none.  The base spans never depend on ``fdr``
    or on other documents."""
    text = F.col("text")
    assign = (text.contains(":") | text.contains("=")) & text.rlike(ASSIGN)
    some = assign | (text.contains("AKIA") & text.rlike(ACCESS)) | text.rlike(HEX) | text.rlike(CANDIDATE)
    src = docs.select(_key(id_col, text_col).alias("doc_key"), F.col(text_col).cast("string").alias("text"))
    flagged = saved(src.where(some).dropDuplicates(["doc_key"]), "flagged")
    base = _matches(flagged, "assign", ASSIGN, 2).where(F.length("value") >= 8)
    base = base.union(_matches(flagged, "access", ACCESS)).union(_matches(flagged, "hex", HEX)).drop("value")
    base = saved(base, "base-spans")
    return base.union(_random(flagged, base, fdr))


def _listed(spans: DataFrame) -> DataFrame:
    """One row a document: its spans by start, then kind; the list is bounded
    by the document."""
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    return spans.groupBy("doc_key").agg(F.sort_array(F.collect_list(F.struct("start", order.alias("order"), "kind", "stop"))).alias("spans"))


def report(docs: DataFrame, fdr: float = FDR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its sorted spans (start, order, kind, stop); an empty
    array for texts without any, null and empty ones too.  Repeated rows are
    returned each; an empty table gives no rows."""
    listed = _listed(spans(docs, fdr, id_col, text_col))
    keyed = docs.select(F.col(id_col).alias("doc_id"), _key(id_col, text_col).alias("doc_key"))
    out = keyed.join(listed, "doc_key", "left")
    none = F.array().cast(listed.schema["spans"].dataType)
    return out.select("doc_id", F.coalesce("spans", none).alias("spans"))


def redacted(docs: DataFrame, put: str = "[SECRET]", fdr: float = FDR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every secret span replaced (overlapping ones together);
    n_chars, where it exists, is counted anew for changed texts."""
    listed = saved(_listed(spans(docs, fdr, id_col, text_col)).withColumnsRenamed({"doc_key": "__key", "spans": "__spans"}), "secret-spans")
    out = docs.withColumn("__text", F.col(text_col).cast("string")).withColumn("__key", _key(id_col, text_col)).join(listed, "__key", "left")
    gap = "substring(__text, a.upto + 1, s.start - a.upto)"
    cut = F.expr(f"""aggregate(__spans, named_struct('parts', cast(array() as array<string>), 'upto', 0L),
        (a, s) -> if(s.stop <= a.upto, a, named_struct(
            'parts', if(s.start < a.upto, a.parts, concat(a.parts, array({gap}, '{put}'))), 'upto', s.stop)),
        a -> concat(array_join(a.parts, ''), substring(__text, a.upto + 1)))""")
    changed = F.col("__spans").isNotNull()
    out = out.withColumn("__new", F.when(changed, cut))
    kept = []
    for c in docs.columns:
        if c == text_col:
            kept.append(F.coalesce("__new", F.col(c)).alias(c))
        elif c == "n_chars":
            kept.append(F.when(changed, F.length("__new")).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c))
        else:
            kept.append(F.col(c))
    return out.select(*kept)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = report(table(spark, sf_dir, "documents"))

    def joined(kept: str) -> str:
        return f"array_join(transform({kept}, s -> concat_ws(':', s.kind, s.start, s.stop)), ',')"

    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS[:3]]
    return out.select("doc_id", *counts, F.sha2(F.expr(joined("filter(spans, s -> s.kind <> 'random')")), 256).alias("base_sha256"),
                      F.expr(joined("spans")).alias("spans"))
