"""Secret scan: fixed patterns, and a battery of randomness tests on long tokens (DataFrame operations only).

The patterns give the base spans. Beside them every run of at least ``MIN_TOKEN`` key characters is a candidate. Its
encoding is inferred (hexadecimal, base 32, base 64), and under the hypothesis that the token is a random key three
tests are made: chi-squared uniformity over the alphabet, runs above and below the alphabet's middle, and serial
correlation of neighbours. Their p-values are combined by Fisher's method.

Natural text is told from keys by rejecting that hypothesis under a Benjamini-Hochberg control of false discoveries,
made separately per encoding and length class, since short tokens say less than long ones: among the tokens thrown
out at most the share ``Q`` is expected to be keys. What is not rejected is added as a span of kind ``random``, unless
a base span touches it. The control counts all candidates of all rows in bins of log10(p), ``BINS`` per stratum, so
what it gathers does not grow with the data.

A row is never shuffled; its spans are arrays of the row. Positions are code points, ends are exclusive. Running sums
go over blocks of ``BLOCK`` matches, so a text full of matches does not cost the square of their number.

Defined results: null text is empty and has no spans; equal rows have equal results; tokens of one letter case without
digits are words and no candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medalith.llm.frames import id_and_text, stored

MIN_TOKEN = 20
Q = 0.05
BINS = 400
BIN_WIDTH = 0.05
BLOCK = 512
KINDS = ("assign", "access", "hex", "random")

#: Fixed patterns of the base kinds; the group holds the part whose length counts.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_VALUE = 12
ACCESS = r"AKIA[A-Z0-9]{14,}+"
HEX = r"[0-9a-f]{16,}+"
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{" + str(MIN_TOKEN) + r",}+={0,2}"
#: Fixed alphabets of the encodings, in the order of their values.
HEX_DIGITS = "0123456789abcdef"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"

SPAN = "array<struct<start:bigint,kind:int,stop:bigint>>"


def _matches(text: Column, pattern: str, group: int, found: Column) -> Column:
    """``before, length, counted`` of each match, in order: characters since the last one, its own, its group's."""
    between = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    inner = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    parts = F.zip_with(
        F.zip_with(F.slice(between, 1, F.size(whole)), whole, lambda b, w: F.struct(F.length(b).alias("before"), F.length(w).alias("length"))),
        inner,
        lambda m, i: F.struct(m["before"].cast("long").alias("before"), m["length"].cast("long").alias("length"), F.length(i).alias("counted"), i.alias("value")),
    )
    return F.when(found, parts).otherwise(F.array().cast("array<struct<before:bigint,length:bigint,counted:int,value:string>>"))


def _placed(matches: str, keep: str, made: str, empty: str) -> str:
    """SQL for the kept matches with their places: running sums inside blocks, on top of sums over blocks.

    ``made`` builds an element from the match ``m`` and its place ``at``.
    """
    blocks = f"transform(sequence(0, cast((size({matches}) - 1) div {BLOCK} as int)), b -> slice({matches}, b * {BLOCK} + 1, {BLOCK}))"
    sums = "transform({}, x -> aggregate(x, 0L, (s, m) -> s + m.before + m.length))".format(blocks)
    bases = f"aggregate({sums}, array(0L), (s, t) -> concat(s, array(element_at(s, -1) + t)))"
    step = (
        f"(s, m) -> named_struct('at', s.at + m.before + m.length, 'made', "
        f"if({keep}, concat(s.made, array({made})), s.made))"
    )
    inner = f"zip_with({blocks}, slice({bases}, 1, size({bases}) - 1), (x, base) -> aggregate(x, named_struct('at', base, 'made', {empty}), {step}, s -> s.made))"
    return f"if(size({matches}) = 0, {empty}, flatten({inner}))"


def _spans(matches: str, kind: int, keep: str) -> str:
    made = f"named_struct('start', s.at + m.before, 'kind', {kind}, 'stop', s.at + m.before + m.length)"
    return _placed(matches, keep, made, f"cast(array() as {SPAN})")


# --- randomness tests -----------------------------------------------------------------------------------


def _normal_tail(z: str) -> str:
    """P(Z > z) of a standard normal variable, by a rational approximation (error below 1e-7, never zero)."""
    k = f"(1 / (1 + 0.2316419 * abs({z})))"
    poly = f"({k} * (0.319381530 + {k} * (-0.356563782 + {k} * (1.781477937 + {k} * (-1.821255978 + {k} * 1.330274429)))))"
    tail = f"(0.3989422804 * exp(-least(0.5 * {z} * {z}, 690D)) * {poly})"
    return f"greatest(if({z} >= 0, {tail}, 1 - {tail}), 1e-300D)"


def _let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with a value bound to a name, so that it is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _tests(value: str) -> str:
    """SQL for ``encoding, n, p`` of one token: the combined p-value under the hypothesis of a random key."""
    body = f"rtrim('=', {value})"
    encoding = f"""case when {body} rlike '^([0-9a-f]+|[0-9A-F]+)$' then 16
      when {body} rlike '^[A-Z2-7]+$' then 32 else 64 end"""
    plain = f"if(e = 16, lower({body}), if(e = 64, translate({body}, '_-', '/+'), {body}))"
    alphabet = f"if(e = 16, '{HEX_DIGITS}', if(e = 32, '{BASE32}', '{BASE64}'))"
    symbols = f"named_struct('encoding', e, 'k', cast(e as double), 's', {plain}, 'letters', {alphabet})"
    counted = """named_struct('encoding', a.encoding, 'n', length(a.s), 'k', a.k, 's', a.s, 'letters', a.letters,
      'codes', transform(filter(split(a.s, ''), c -> c <> ''), c -> cast(locate(c, a.letters) - 1 as double)),
      'halves', translate(a.s, a.letters, concat(repeat('L', a.encoding div 2), repeat('H', a.encoding div 2))))"""
    figures = """named_struct('encoding', b.encoding, 'n', b.n, 'k', b.k,
      'squares', aggregate(filter(split(b.letters, ''), c -> c <> ''), 0D, (s, c) -> s + pow(b.n - length(replace(b.s, c, '')), 2)),
      'high', cast(b.n - length(replace(b.halves, 'H', '')) as double),
      'runs', 1 + (b.n - length(replace(b.halves, 'LH', ''))) / 2 + (b.n - length(replace(b.halves, 'HL', ''))) / 2,
      'serial', aggregate(zip_with(slice(b.codes, 1, b.n - 1), slice(b.codes, 2, b.n - 1),
        (x, y) -> (x - (b.k - 1) / 2) * (y - (b.k - 1) / 2)), 0D, (s, x) -> s + x))"""
    scores = """named_struct('encoding', f.encoding, 'n', f.n,
      'uniform', (f.k / f.n * f.squares - f.n - (f.k - 1)) / sqrt(2 * (f.k - 1) * (1 - 1 / f.n)),
      'runs', abs(f.runs - (1 + 2 * f.high * (f.n - f.high) / f.n)) / sqrt(greatest(
        2 * f.high * (f.n - f.high) * (2 * f.high * (f.n - f.high) - f.n) / (pow(f.n, 2) * (f.n - 1)), 0.01D)),
      'serial', abs(f.serial) / ((pow(f.k, 2) - 1) / 12 * sqrt(cast(f.n - 1 as double))))"""
    one_sided, both = _normal_tail("z.uniform"), "ln(least(1D, 2 * {}))"
    logs = f"ln({one_sided}) + {both.format(_normal_tail('z.runs'))} + {both.format(_normal_tail('z.serial'))}"
    # Fisher: minus twice the sum of logs is chi-squared with six degrees of freedom
    fisher = _let("l", f"greatest(-680D, {logs})", "greatest(1e-300D, exp(l) * (1 - l + l * l / 2))")
    result = f"named_struct('encoding', z.encoding, 'n', z.n, 'p', {fisher})"
    return _let("e", encoding, _let("a", symbols, _let("b", counted, _let("f", figures, _let("z", scores, result)))))


def _stratum(c: str) -> str:
    """Encoding and length class of a candidate as one number."""
    return f"{c}.encoding * 100 + cast(floor(2 * log2({c}.n)) as int)"


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, base, candidates`` per row: the spans of the patterns, and the tested tokens with their p-values."""
    d = id_and_text(docs, id_col, text_col)
    lowered = F.lower("text")
    assigned = F.lit(False)
    for word in ASSIGN_WORDS:
        assigned = assigned | lowered.contains(word)
    yes = F.lit(True)
    found = d.select(
        "doc_id",
        _matches(F.col("text"), ASSIGN, 1, assigned).alias("assigned"),
        _matches(F.col("text"), ACCESS, 0, F.col("text").contains("AKIA")).alias("access"),
        _matches(F.col("text"), HEX, 0, yes).alias("hexes"),
        _matches(F.col("text"), TOKEN, 0, yes).alias("tokens"),
    )
    word = r"(m.value rlike '[0-9]' or (m.value rlike '[a-z]' and m.value rlike '[A-Z]')) and m.value rlike '[A-Za-z]'"
    token = "named_struct('start', s.at + m.before, 'stop', s.at + m.before + m.length, 'value', m.value)"
    placed = found.select(
        "doc_id",
        F.expr(f"concat({_spans('assigned', 0, f'm.counted >= {ASSIGN_VALUE}')}, {_spans('access', 1, 'true')}, {_spans('hexes', 2, 'true')})").alias("base"),
        F.expr(_placed("tokens", word, token, "cast(array() as array<struct<start:bigint,stop:bigint,value:string>>)")).alias("tokens"),
    )
    tested = F.expr(f"transform(tokens, t -> named_struct('start', t.start, 'stop', t.stop, 'test', {_tests('t.value')}))")
    return placed.select("doc_id", F.array_sort("base").alias("base"), tested.alias("candidates"))


def thresholds(found: DataFrame, q: float = Q) -> DataFrame:
    """Per stratum the largest p at which a token is still rejected; at most some hundred rows."""
    one = found.select(F.explode("candidates.test").alias("t"))
    binned = one.select(F.expr(_stratum("t")).alias("stratum"), F.expr(f"least({BINS - 1}, cast(floor(-log10(t.p) / {BIN_WIDTH}) as int))").alias("bin"))
    counts = binned.groupBy("stratum", "bin").agg(F.count("*").alias("n"))
    down = Window.partitionBy("stratum").orderBy(F.desc("bin"))
    ranked = counts.select("stratum", "bin", F.sum("n").over(down).alias("rank"), F.sum("n").over(Window.partitionBy("stratum")).alias("all"))
    edge = F.pow(F.lit(10.0), -F.col("bin") * BIN_WIDTH)
    return ranked.where(edge <= q * F.col("rank") / F.col("all")).groupBy("stratum").agg(F.max(edge).alias("p"))


def find_secrets(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", q: float = Q) -> DataFrame:
    """``doc_id, base, spans`` per row; both are arrays of ``start, kind, stop`` with the kind's place in ``KINDS``."""
    found = stored(spark, scanned(docs, id_col, text_col), "secrets")
    limits = {r.stratum: r.p for r in thresholds(found, q).collect()}  # one row per encoding and length class
    limit = "0D"
    if limits:
        limit = f"coalesce(map({', '.join(f'{s}, {p!r}D' for s, p in sorted(limits.items()))})[{_stratum('c.test')}], 0D)"
    kept = f"""transform(filter(candidates, c -> c.test.p > {limit} and not exists(base, b -> b.start < c.stop and c.start < b.stop)),
      c -> named_struct('start', c.start, 'kind', {KINDS.index('random')}, 'stop', c.stop))"""
    return found.select("doc_id", "base", F.expr(f"array_sort(concat(base, {kept}))").alias("spans"))


def spans_text(spans: str) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"concat_ws(',', transform({spans}, s -> concat_ws(':', {names}[s.kind], s.start, s.stop)))")


def kind_count(spans: str, kind: str) -> Column:
    return F.expr(f"cast(size(filter({spans}, s -> s.kind = {KINDS.index(kind)})) as bigint)")
