"""Secrets in texts: fixed patterns, and a battery of randomness tests on everything that looks encoded.

Patterns (`BASE`) give the base spans. Besides, each run of 16 or more characters of the encoding alphabets is a
candidate if an encoding fits it: hexadecimal, base 32, base 36 or base 64, the first and third also in groups joined by
'-'. A '=' within is no part of a run, as padding at the end it is. Under the hypothesis that its characters are
drawn evenly and independently from that alphabet, three tests are made: chi-squared for evenness, the runs above and
below the alphabet's middle, and the correlation of neighbours. The smallest p-value, times three, is the candidate's.

Random strings have p-values that are spread evenly; other strings have small ones. So in each class of encoding and
length, the p-values above 0.2 tell how many candidates are random (Storey's estimate), and a cut is chosen such that at
most a share `fdr` of the candidates above it are not. Classes by length keep long strings, for which the tests are
strong, from covering for short ones. The cuts come from counts over all documents: a table of at most 600 rows.

Everything is SQL functions: texts are read once, and only spans are kept.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.tables import checkpointed, columns_of, whole

# The kinds of base spans in their order, and their patterns.
BASE = {
    "assign": r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
}
LEAST_VALUE = 6
KINDS = [*BASE, "random"]

# '=' ends a run or pads it: what follows NAME= is a run of its own.
_RUN = (r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{16,}(?:=+(?![A-Za-z0-9+/_=-]))?"
        r"|(?=[A-Za-z0-9+/_=-]{16})[A-Za-z0-9+/_-]{1,15}=+(?![A-Za-z0-9+/_=-]))")
#: Encoding: (alphabet, pattern of the whole string); the first that fits.
ENCODINGS = {
    "hex": ("0123456789abcdef", r"^(?=.*[0-9])(?=.*[a-fA-F])([0-9a-f]+|[0-9A-F]+)$"),
    "base32": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+=*$"),
    "base36": ("0123456789abcdefghijklmnopqrstuvwxyz", r"^(?=.*[0-9])(?=.*[a-zA-Z])([0-9a-z]+|[0-9A-Z]+)$"),
    "base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
               r"^(?=.*[a-z])(?=.*[A-Z])(?=.*[0-9]|.*[a-z][A-Z])[A-Za-z0-9+/_-]+=*$"),
    # groups joined by '-', as in a UUID, are classes of their own: words joined by '-' must not spoil the cuts of others
    # (no repeated group in the pattern: Java's matcher would recurse once for each of a long string's groups)
    "hex_groups": ("0123456789abcdef",
                   r"^(?=.*[0-9])(?=.*[a-fA-F])(?=.*-)(?!.*--)([0-9a-f][0-9a-f-]*[0-9a-f]|[0-9A-F][0-9A-F-]*[0-9A-F])$"),
    "base36_groups": ("0123456789abcdefghijklmnopqrstuvwxyz",
                      r"^(?=.*[0-9])(?=.*[a-zA-Z])(?=.*-)(?!.*--)([0-9a-z][0-9a-z-]*[0-9a-z]|[0-9A-Z][0-9A-Z-]*[0-9A-Z])$"),
}
#: Lengths at which a new class begins.
BANDS = [16, 24, 32, 48, 96]
_LAMBDA = 0.2
_BINS = 20


def _spans(text: Column, pattern: str) -> Column:
    """array of (start, end, hit) of the leftmost matches that do not overlap, in code points."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))
    empty = F.array().cast("array<struct<start:int,end:int,hit:string>>")

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + F.char_length(x["gap"])
        end = start + F.char_length(x["hit"])
        one = F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("hit"))
        return F.struct(end.alias("at"), F.array_append(state["out"], one).alias("out"))

    zipped = F.transform(F.sequence(F.lit(0), F.size(hits) - 1), lambda i: F.struct(gaps[i].alias("gap"), hits[i].alias("hit")))
    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))
    return F.when(F.size(hits) > 0, F.aggregate(zipped, start, add, lambda s: s["out"])).otherwise(empty)


def _of_kind(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def _tail(z: Column) -> Column:
    """The normal probability above z, to four digits."""
    z = F.greatest(F.least(z, F.lit(12.0)), F.lit(-12.0))
    return 1 / (1 + F.exp(1.5976 * z + 0.07056 * z * z * z))


def encoding(token: Column) -> Column:
    """The name of the first encoding that fits, else NULL."""
    name = F.lit(None).cast("string")
    for key in reversed(ENCODINGS):
        name = F.when(token.rlike(ENCODINGS[key][1]), F.lit(key)).otherwise(name)
    return name


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often `use` names it."""
    return F.transform(F.array(value), use)[0]


def _p_value(token: Column, alphabet: str, fold: bool) -> Column:
    """Of the hypothesis that the token's characters are drawn evenly and independently. One pass over the characters for
    the runs and the correlation, and one for each letter of the alphabet."""
    token = F.translate(token, "-", "") if fold else F.rtrim(F.translate(token, "-_=", "+/ "))
    if fold:
        token = F.lower(token) if alphabet.islower() else F.upper(token)
    return _bound(token, lambda t: _bound(_moments(t, alphabet), lambda m: _least_p(m, len(alphabet))))


def _moments(token: Column, alphabet: str) -> Column:
    """Sums over the characters' places x in the alphabet: rows, x, x², neighbours' products, ends, upper half, turns."""
    half = len(alphabet) / 2
    zero = F.lit(0.0)
    names = ("n", "x", "xx", "xy", "first", "last", "ones", "turns")

    def add(m: Column, x: Column) -> Column:
        after = m["n"] > 0
        turned = after & ((x > half) != (m["last"] > half))
        values = (
            m["n"] + 1, m["x"] + x, m["xx"] + x * x, m["xy"] + x * m["last"], F.when(after, m["first"]).otherwise(x), x,
            m["ones"] + F.when(x > half, 1.0).otherwise(0.0), m["turns"] + F.when(turned, 1.0).otherwise(0.0))
        return F.struct(*[v.alias(n) for v, n in zip(values, names)])

    places = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(alphabet), c).cast("double"))
    sums = F.aggregate(places, F.struct(*[zero.alias(n) for n in names]), add)
    squares = F.aggregate(
        F.array(*[F.lit(c) for c in alphabet]), zero,
        lambda s, c: s + F.pow((F.char_length(token) - F.char_length(F.replace(token, c, F.lit("")))).cast("double"), F.lit(2.0)))
    return F.struct(sums.alias("m"), squares.alias("squares"))


def _least_p(moments: Column, k: int) -> Column:
    m, squares = moments["m"], moments["squares"]
    size, free = m["n"], k - 1
    chi = k / size * squares - size
    z_chi = (F.cbrt(F.greatest(chi, F.lit(0.0)) / free) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free))
    expected = 2 * m["ones"] * (size - m["ones"]) / size
    spread = F.sqrt(F.greatest(expected * (expected - 1) / (size - 1), F.lit(1e-9)))
    z_runs = F.abs(m["turns"] - expected) / spread
    mean = m["x"] / size
    square = m["xx"] - size * mean * mean
    product = m["xy"] - mean * (2 * m["x"] - m["first"] - m["last"]) + (size - 1) * mean * mean
    z_serial = F.abs(product / F.greatest(square, F.lit(1e-9))) * F.sqrt(size)
    return F.least(F.lit(1.0), 3 * F.least(_tail(z_chi), 2 * _tail(z_runs), 2 * _tail(z_serial)))


def battery(token: Column, name: Column) -> Column:
    """The p-value of a token under its encoding."""
    p = F.lit(None).cast("double")
    for key, (alphabet, _) in reversed(ENCODINGS.items()):
        p = F.when(name == key, _p_value(token, alphabet, key.startswith(("hex", "base36")))).otherwise(p)
    return p


def _band(length: Column) -> Column:
    band = F.lit(0)
    for k, low in enumerate(BANDS):
        band = F.when(length >= low, F.lit(k)).otherwise(band)
    return band


def found_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, candidates): the spans by pattern, and the candidates with encoding, band and p-value."""
    rows = columns_of(docs, id=id_col, text=text_col).select("id", whole("text").alias("text"))
    parts = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        spans = _spans(F.col("text"), pattern)
        if kind == "assign":
            spans = F.filter(spans, lambda s: F.char_length(F.regexp_extract(s["hit"], pattern, 2)) >= LEAST_VALUE)
        parts.append(_of_kind(spans, k))
    base = F.array_sort(F.concat(*parts))
    tokens = F.transform(_spans(F.col("text"), _RUN), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["hit"].alias("hit"), encoding(s["hit"]).alias("encoding")))
    tokens = F.filter(tokens, lambda s: s["encoding"].isNotNull())
    rows = rows.select("id", base.alias("base"), tokens.alias("tokens"))
    free = F.filter("tokens", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    rows = rows.select("id", "base", free.alias("tokens"))
    tested = F.transform("tokens", lambda t: F.struct(
        t["start"].alias("start"), t["end"].alias("end"), t["encoding"].alias("encoding"),
        _band(t["end"] - t["start"]).alias("band"), battery(t["hit"], t["encoding"]).alias("p")))
    return rows.select("id", "base", tested.alias("candidates"))


def accepted_above(candidates: DataFrame, fdr: float) -> dict[tuple[str, int], float]:
    """The cut of each (encoding, band) of (encoding, band, p), from counts in bins of p; classes without one are left out."""
    counts: dict[tuple[str, int], list[int]] = {}
    bin_of = F.least(F.floor(F.col("p") * _BINS), F.lit(_BINS - 1)).cast("int")
    for r in candidates.groupBy("encoding", "band", bin_of.alias("bin")).count().collect():
        counts.setdefault((r["encoding"], r["band"]), [0] * _BINS)[r["bin"]] += r["count"]
    cuts = {}
    for key, bins in counts.items():
        random = min(1.0, sum(bins[int(_LAMBDA * _BINS):]) / (1 - _LAMBDA) / sum(bins)) * sum(bins)
        for k in range(_BINS):
            above = sum(bins[k:])
            if above and 1 - min(1.0, random * (1 - k / _BINS) / above) <= fdr:
                cuts[key] = k / _BINS
                break
    return cuts


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = 0.1) -> DataFrame:
    """(id, spans): each document's secrets as an array of (start, kind, end), kind by its place in KINDS.

    Spans are in code points with an exclusive end, ordered by start, kind and end. A random string that meets a base
    span is not added. A NULL or empty text has no spans. Ids may be NULL or repeated; an empty table gives no rows;
    further columns are ignored.
    """
    found = checkpointed(found_spans(docs, id_col, text_col))
    cuts = accepted_above(found.select(F.explode("candidates").alias("c")).select("c.*"), fdr)

    def good(c: Column) -> Column:
        out = F.lit(False)
        for (name, band), cut in sorted(cuts.items()):
            out = out | ((c["encoding"] == name) & (c["band"] == band) & (c["p"] >= cut))
        return out

    added = _of_kind(F.filter("candidates", good), len(BASE))
    return found.select(F.col("id").alias(id_col), F.array_sort(F.concat("base", added)).alias("spans"))


def of_kind(spans: Column, kind: str) -> Column:
    """How many spans are of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def digest(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")
