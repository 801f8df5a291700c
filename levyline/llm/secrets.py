"""Secret scan: three patterns, and a battery of randomness tests for strings that no pattern names.

Candidates are long runs of encoding characters. Each gets the narrowest encoding that holds it (hex, base 32, base 36, base 62
or base 64; of letters only: 26 or 52 letters); a run without one, as it mixes alphabets, is cut at / + _ - and its parts are candidates. It, its characters, as numbers of that alphabet, face three tests of randomness: chi-squared for uniform
use of the alphabet, the number of runs above and below its middle, and the correlation of neighbours. Their p-values are
combined by Fisher's method. A candidate is dropped as ordinary text where the false-discovery procedure of Benjamini and
Hochberg rejects its randomness among the candidates of like encoding and length; the others are reported.
The p-values are counted in bins, so the procedure needs a few hundred numbers per kind, not the candidates.

Only built-in column functions are used. Offsets are code points, the end is exclusive.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from levyline.session import written

# The patterns of the base spans.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"  # the runs of [0-9a-f]+ that have 32 characters
KINDS = ("assign", "access", "hex", "random")
# A candidate: at least this many encoding characters.
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}+={0,2}"
LEAST_BITS = 80.0  # a string of fewer possible values says too little to be told from text
LEAST_PART = 14  # characters; fewer of 62 have not these bits
DISCOVERY_RATE = 0.05
BIN = 0.05  # width of a bin of -log10(p)
TOP_BIN = 600
_SUMS = 512

# Encodings from narrow to wide: name, pattern, alphabet in order of value.
_DIGITS, _LOW, _UP = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = (
    ("hex", "^[0-9a-f]+$", _DIGITS + _LOW[:6]),
    ("hex_upper", "^[0-9A-F]+$", _DIGITS + _UP[:6]),
    ("base32", "^[A-Z2-7]+$", _UP + "234567"),
    ("base36", "^[0-9a-z]+$", _DIGITS + _LOW),
    ("base36_upper", "^[0-9A-Z]+$", _DIGITS + _UP),
    ("base62", "^[0-9A-Za-z]+$", _DIGITS + _UP + _LOW),
    ("base64", "^[0-9A-Za-z+/]+$", _UP + _LOW + _DIGITS + "+/"),
    ("base64url", "^[0-9A-Za-z_-]+$", _UP + _LOW + _DIGITS + "-_"),
)
# For runs without a digit.
LETTERS = (("lower", "^[a-z]+$", _LOW), ("upper", "^[A-Z]+$", _UP), ("letters", "^[A-Za-z]+$", _UP + _LOW))


def running_sums(values: Column) -> Column:
    """Sums of an array up to each of its elements, in blocks so that no long list grows element by element."""

    def inside(block: Column, start: Column) -> Column:
        empty = F.struct(start.alias("at"), F.array().cast("array<bigint>").alias("sums"))
        return F.aggregate(block, empty, lambda acc, x: F.struct(
            (acc.at + x).alias("at"), F.array_append(acc.sums, acc.at + x).alias("sums")), lambda acc: acc.sums)

    def total(block: Column) -> Column:
        return F.aggregate(block, F.lit(0).cast("bigint"), lambda acc, x: acc + x)

    starts = F.sequence(F.lit(1), F.size(values), F.lit(_SUMS))
    blocks = F.transform(starts, lambda s: F.slice(values, s, F.lit(_SUMS)))
    sums = inside(F.transform(blocks, total), F.lit(0).cast("bigint"))
    parts = F.zip_with(blocks, sums, lambda block, end: inside(block, end - total(block)))
    return F.when(F.size(values) > 0, F.flatten(parts)).otherwise(F.array().cast("array<bigint>"))


_SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"


def spans_of(text: Column, pattern: str, kind: int, kept: Column | None = None) -> Column:
    """Spans of the leftmost non-overlapping matches; `kept` is an array of booleans, one per match."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    lengths = F.transform(matches, lambda m: F.length(m).cast("bigint"))
    between = F.transform(F.split(text, pattern, -1), lambda p: F.length(p).cast("bigint"))
    steps = F.zip_with(F.slice(between, F.lit(1), F.size(matches)), lengths, lambda a, b: a + b)
    ends = running_sums(steps)
    spans = F.zip_with(ends, lengths, lambda e, n: F.struct((e - n).alias("start"), F.lit(kind).alias("kind"), e.alias("end")))
    if kept is not None:
        paired = F.zip_with(spans, kept, lambda s, k: F.struct(s.alias("s"), k.alias("k")))
        spans = F.transform(F.filter(paired, lambda z: z.k), lambda z: z.s)
    return F.when(text.rlike(pattern), spans.cast(_SPAN)).otherwise(F.array().cast(_SPAN))


def _upper_tail(z: Column) -> Column:
    """Chance that a standard normal number is larger than z, to 4 digits."""
    z = F.greatest(F.lit(-8.0), F.least(F.lit(8.0), z))
    return 1 / (1 + F.exp(1.5976 * z + 0.07056 * z * z * z))


def _two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), 2 * _upper_tail(F.abs(z)))


def encoding_of(text: Column) -> Column:
    """Number of the narrowest encoding, null for plain numbers, words with marks between and mixtures of alphabets."""
    core = F.rtrim(text, F.lit("="))
    mixed = core.rlike("[0-9]") & core.rlike("[A-Za-z]")
    cases = F
    for i, (_, pattern, _) in enumerate(LETTERS):
        cases = cases.when(core.rlike(pattern), F.lit(len(ENCODINGS) + i))
    cases = cases.when(~mixed, F.lit(None).cast("int"))
    for i, (_, pattern, _) in enumerate(ENCODINGS):
        cases = cases.when(core.rlike(pattern), F.lit(i))
    return cases


def candidates(runs: DataFrame) -> DataFrame:
    """row, token, span, encoding of runs (row, token, span): a run that has an encoding, else its parts between / + _ - that have one."""
    runs = runs.withColumn("encoding", encoding_of(F.col("token")))
    parts = F.split("token", "[/+_-]", -1)
    ends = running_sums(F.transform(parts, lambda p: F.length(p).cast("bigint") + 1))
    placed = F.zip_with(parts, ends, lambda p, e: F.struct(p.alias("token"), F.struct(
        (F.col("span.start") + e - 1 - F.length(p)).alias("start"), F.col("span.kind").alias("kind"), (F.col("span.start") + e - 1).alias("end")).alias("span")))
    long = F.filter(placed, lambda x: F.length(x.token) >= LEAST_PART)
    cut = runs.filter("encoding IS NULL").select("row", F.inline(long)).withColumn("encoding", encoding_of(F.col("token")))
    return runs.filter("encoding IS NOT NULL").select("row", "token", "span", "encoding").unionByName(cut.filter("encoding IS NOT NULL"))


def battery(rows: DataFrame) -> DataFrame:
    """Adds n, bits and p (of randomness) to rows (token, encoding)."""
    alphabet = F.element_at(F.array(*[F.lit(a) for _, _, a in ENCODINGS + LETTERS]), F.col("encoding") + 1)
    rows = rows.withColumns({"core": F.rtrim("token", F.lit("=")), "alphabet": alphabet})
    rows = rows.withColumns({"n": F.length("core").cast("double"), "k": F.length("alphabet").cast("double")})
    values = F.transform(F.filter(F.split("core", ""), lambda c: c != ""), lambda c: F.position(c, F.col("alphabet")).cast("double") - 0.5)
    rows = rows.withColumn("x", values)
    add = lambda acc, v: acc + v
    zero = F.lit(0.0)
    times = F.transform(F.array_distinct("x"), lambda v: F.size(F.filter("x", lambda w: w == v)).cast("double"))
    squares = F.aggregate(times, zero, lambda acc, c: acc + c * c)
    mean = F.aggregate("x", zero, add) / F.col("n")
    rows = rows.withColumns({"squares": squares, "mean": mean})
    high = F.transform("x", lambda v: F.when(v > F.col("k") / 2, 1.0).otherwise(0.0))
    off = F.transform("x", lambda v: v - F.col("mean"))
    rows = rows.withColumns({"high": high, "off": off})
    later = lambda name: F.slice(name, F.lit(2), F.size(name))
    earlier = lambda name: F.slice(name, F.lit(1), F.size(name) - 1)
    changes = F.aggregate(F.zip_with(earlier("high"), later("high"), lambda a, b: F.abs(a - b)), zero, add)
    products = F.aggregate(F.zip_with(earlier("off"), later("off"), lambda a, b: a * b), zero, add)
    rows = rows.withColumns({
        "above": F.aggregate("high", zero, add), "runs": changes + 1, "products": products,
        "spread": F.aggregate("off", zero, lambda acc, v: acc + v * v)})
    n, k, above = F.col("n"), F.col("k"), F.col("above")
    # Wilson and Hilferty's cube root makes chi-squared normal
    chi = F.col("squares") * k / n - n
    df = k - 1
    p_chi = _upper_tail((F.pow(F.greatest(chi, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df)))
    expected = 2 * above * (n - above) / n + 1
    spread = F.sqrt((expected - 1) * (expected - 2) / (n - 1))
    one_side = (above == 0) | (above == n) | (spread <= 0)
    p_runs = F.when(one_side, F.pow(F.lit(2.0), 1 - n)).otherwise(_two_sided((F.col("runs") - expected) / spread))
    p_serial = F.when(F.col("spread") <= 0, F.pow(F.lit(2.0), 1 - n)).otherwise(
        _two_sided((F.col("products") / F.col("spread") + 1 / n) * F.sqrt(n)))
    x = -(F.ln(F.greatest(p_chi, F.lit(1e-12))) + F.ln(F.greatest(p_runs, F.lit(1e-12))) + F.ln(F.greatest(p_serial, F.lit(1e-12))))
    p = F.exp(-x) * (1 + x + x * x / 2)
    return rows.withColumns({"p": p, "bits": n * F.log2(k)}).drop(
        "core", "alphabet", "k", "x", "squares", "mean", "high", "off", "above", "runs", "products", "spread")


def _tested(docs: DataFrame) -> DataFrame:
    """doc_id, a number of the row, base spans, and the candidates with their spans."""
    text = F.coalesce("text", F.lit(""))
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    rows = docs.select(
        "doc_id", F.monotonically_increasing_id().alias("row"),  # written below, so it stays the same
        F.concat(
            spans_of(text, ASSIGN, 0, F.transform(values, lambda v: F.length(v) >= 8)),
            F.filter(spans_of(text, ACCESS, 1), lambda s: s.end - s.start >= 16),
            spans_of(text, HEX, 2),
        ).alias("base"),
        spans_of(text, CANDIDATE, 3).alias("spans"),
        F.when(text.rlike(CANDIDATE), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))).alias("tokens"),
    )
    return written(rows, "secret-spans")


def scan(docs: DataFrame, rate: float = DISCOVERY_RATE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans of every row of `docs` (doc_id, text; others are left out).

    A null text is empty. Texts without spans have the digest of an empty text. Repeated rows are scanned each.
    """
    rows = _tested(docs)
    # candidates are judged by what they are, so that equal ones are counted together and looked up by their text
    found = candidates(rows.filter("size(spans) > 0").select("row", F.inline(F.arrays_zip("tokens", "spans"))).withColumnsRenamed({"tokens": "token", "spans": "span"}))
    tokens = found.groupBy("token", "encoding").agg(F.count("*").alias("times"))
    tested = battery(tokens).filter(F.col("bits") >= LEAST_BITS)
    step = F.least(F.floor(-F.log10(F.greatest("p", F.lit(1e-300))) / BIN), F.lit(TOP_BIN)).cast("int")
    stratum = (F.col("encoding") * 100 + F.floor(F.log2("n"))).cast("int")
    tested = written(tested.select("token", "times", stratum.alias("stratum"), step.alias("step")), "secret-tests")
    counts = tested.groupBy("stratum", "step").agg(F.sum("times").alias("times"))
    falling = Window.partitionBy("stratum").orderBy(F.desc("step"))
    everything = F.sum("times").over(Window.partitionBy("stratum"))
    passed = counts.withColumns({"seen": F.sum("times").over(falling), "all": everything}).filter(
        F.pow(F.lit(10.0), -BIN * F.col("step")) <= rate * F.col("seen") / F.col("all"))
    # at most 11 encodings times 31 lengths
    limits = {r[0]: r[1] for r in passed.groupBy("stratum").agg(F.min("step")).collect()}
    limit = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])[F.col("stratum")] if limits else F.lit(None).cast("int")
    secret = tested.filter(limit.isNull() | (F.col("step") < limit)).select("token")
    return _summed(rows, found, secret)


def _summed(rows: DataFrame, found: DataFrame, secret: DataFrame) -> DataFrame:
    random = found.join(secret, "token").groupBy("row").agg(F.collect_list("span").alias("random"))
    # what a pattern has named already is not named again
    fresh = F.filter("random", lambda r: ~F.exists("base", lambda b: (b.start < r.end) & (r.start < b.end)))
    whole = rows.join(random, "row", "left").withColumn("random", F.coalesce(fresh, F.array().cast(_SPAN)))
    listed = lambda spans: F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(
        ":", F.element_at(F.array(*[F.lit(k) for k in KINDS]), s.kind + 1), s.start.cast("string"), s.end.cast("string"))), ",")
    number = lambda kind: F.size(F.filter("base", lambda s: s.kind == kind)).cast("long")
    return whole.select(
        "doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
        F.size("random").cast("long").alias("n_random"), F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listed(F.concat("base", "random")).alias("spans"))


