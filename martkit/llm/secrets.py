"""Secret scans with multipart credential linking, in DataFrame expressions only.

Base spans are found by pattern in every text.  A match's place comes from the texts between matches: ``split`` gives the
gaps, ``regexp_extract_all`` the matches, and sums of their lengths the places in code points.

Some parts mean little alone: a user name, a short password, a long random word, an address of a service.  These weak
candidates are reported only near their complement.  Each identifier, secret and endpoint spans a scope, ``SCOPE`` code
points around it, and candidates are interval-joined to scopes of their document: an identifier needs a secret, a secret
needs an identifier, an endpoint needs both.  Scopes are cut into buckets, the join is a semi-join on (document, bucket)
with the interval as its condition, so it neither lists pairs nor compares parts that lie far apart.

Defined results: a null text is empty; an empty text has no spans; spans of different kinds may overlap; rows that agree in
id and text get the same spans.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import whole_text, written

SCOPE = 400
_VALUE = r"""["']?\x20*[:=]\x20*["']?"""
#: The base kinds, in order (fixed values): pattern, and what must hold of a match.
ASSIGN = rf"(?i)(password|passwd|secret|token|api_?key){_VALUE}([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{12,}"        # a maximal run has no longer match that begins later
HEX = "[0-9a-f]{32,}"
#: Weak candidates: kind -> role, pattern, a cheap test of the text in lower case.
_NAMED = r"(?i)(?<![A-Za-z0-9])(user(?:_?name)?|login|account|client_?id|access_?key_?id)"
WEAK = {
    "ident": ("identifier", rf"{_NAMED}{_VALUE}([A-Za-z0-9@+/_.-]{{3,}})", ("user", "login", "account", "client", "access")),
    "short": ("secret", None, ()),
    "random": ("secret", r"(?<![A-Za-z0-9+/])(?=[A-Za-z+/]*[0-9])(?=[a-z0-9+/]*[A-Z])(?=[A-Z0-9+/]*[a-z])[A-Za-z0-9+/]{32,}={0,2}", None),
    "endpoint": ("endpoint", r"(?i)(?:https?|jdbc:[a-z0-9]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3|ftp)://[A-Za-z0-9._:@-]+", ("://",)),
}
KINDS = ("assign", "access", "hex", *WEAK)
_ROLES = {"assign": "secret", "access": "identifier", "hex": "secret"} | {k: v[0] for k, v in WEAK.items()}
_SPANS = "array<struct<start: bigint, stop: bigint, n: int>>"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value taken once: what a lambda refers to from outside is computed anew for each element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _before(lengths: Column) -> Column:
    """For each element the sum of those before it.  Sums are taken in pieces of 256, so that thousands of matches in one
    text cost little."""
    piece = 256

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0).cast("long"), lambda a, v: a + v)

    def summed(all_: Column, starts: Column) -> Column:
        return F.transform(all_, lambda _, i: F.element_at(starts, F.floor(i / piece).cast("int") + 1)
                           + total(F.slice(all_, (F.floor(i / piece) * piece + 1).cast("int"), (i % piece).cast("int"))))
    last = F.greatest(F.ceil(F.size(lengths) / piece).cast("int") - 1, F.lit(0))
    pieces = F.transform(F.sequence(F.lit(0), last), lambda p: total(F.slice(lengths, p * piece + 1, piece)))
    return _let(pieces, lambda ps: _let(F.transform(ps, lambda _, p: total(F.slice(ps, F.lit(1), p))), lambda starts: summed(lengths, starts)))


def spans(text: Column, pattern: str, value_group: bool = False) -> Column:
    """start, stop (exclusive) and n (length of group 2) of each leftmost non-overlapping match."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if value_group else found
    # Lengths of the matches, of the gaps before them and of their values.
    sizes = F.struct(F.transform(found, lambda m: F.char_length(m).cast("long")).alias("m"),
                     F.transform(F.split(text, pattern, -1), lambda g: F.char_length(g).cast("long")).alias("g"),
                     F.transform(values, lambda v: F.char_length(v)).alias("v"))

    def placed(s: Column) -> Column:
        steps = F.zip_with(s["m"], F.slice(s["g"], F.lit(1), F.size(s["m"])), lambda m, g: m + g)
        return _let(steps, lambda all_: _let(_before(all_), lambda before: F.transform(before, lambda at, i: F.struct(
            (at + F.get(s["g"], i)).alias("start"), (at + F.get(s["g"], i) + F.get(s["m"], i)).alias("stop"), F.get(s["v"], i).alias("n")))))
    return F.when(text.rlike(pattern), _let(sizes, placed)).otherwise(F.array().cast(_SPANS))


def _if(test: Column, value: Column) -> Column:
    return F.when(test, value).otherwise(F.array().cast(_SPANS))


def _holds(lower: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [lower.contains(w) for w in words])


def _tagged(column: Column, kind: str) -> Column:
    return F.transform(column, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["stop"].alias("stop")))


def _joined(parts: Column) -> Column:
    """kind:start:end by start, then kind as listed."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.sort_array(parts), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _scoped(parts: DataFrame, scope: int) -> DataFrame:
    """The weak candidates near their complement.  ``parts``: doc, kind, role, start, stop."""
    weak = parts.where(F.col("kind") >= 3).withColumn("bucket", F.floor(F.col("start") / (2 * scope)))
    near = parts.select(F.col("doc").alias("d"), F.col("role").alias("of"), (F.col("start") - scope).alias("low"), (F.col("stop") + scope).alias("high"))
    near = near.withColumn("b", F.explode(F.sequence(F.floor(F.col("low") / (2 * scope)), F.floor(F.col("high") / (2 * scope)))))

    def beside(rows: DataFrame, role: str) -> DataFrame:
        inside = (F.col("doc") == F.col("d")) & (F.col("bucket") == F.col("b")) & F.col("start").between(F.col("low"), F.col("high"))
        return rows.join(near.where(F.col("of") == role), inside, "left_semi")
    identifiers = beside(weak.where("role = 'identifier'"), "secret")
    secrets = beside(weak.where("role = 'secret'"), "identifier")
    endpoints = beside(beside(weak.where("role = 'endpoint'"), "secret"), "identifier")
    return identifiers.unionByName(secrets).unionByName(endpoints)


def secret_spans(docs: DataFrame, scope: int = SCOPE, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_linked (weak candidates near their complement)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("body")).withColumn("low", F.lower("body"))
    body, low = F.col("body"), F.col("low")
    long_run = body.rlike("[A-Za-z0-9+/]{32}")
    rows = rows.select(
        "doc_id", "body", _if(_holds(low, ("password", "passwd", "secret", "token", "apikey", "api_key")), spans(body, ASSIGN, True)).alias("named"),
        _if(body.contains("AKIA"), spans(body, ACCESS)).alias("access"), _if(long_run, spans(body, HEX)).alias("hex"),
        *[_if(long_run if tests is None else _holds(low, tests), spans(body, pattern)).alias(k) for k, (_, pattern, tests) in WEAK.items() if pattern])
    rows = rows.withColumn("assign", F.filter("named", lambda s: s["n"] >= 8)).withColumn(
        "short", F.filter("named", lambda s: s["n"].between(4, 7)))
    # A random word that is a hexadecimal or named secret already is no candidate of its own.
    rows = rows.withColumn("random", F.filter("random", lambda r: ~F.exists(
        F.concat("assign", "hex", "access"), lambda s: (s["start"] <= r["start"]) & (r["stop"] <= s["stop"]))))
    weak = F.concat(*[_tagged(F.col(k), k) for k in WEAK])
    base = F.concat(*[_tagged(F.col(k), k) for k in ("assign", "access", "hex")])
    roles = F.array(*[F.lit(_ROLES[k]) for k in KINDS])
    rows = rows.select("doc_id", base.alias("base"), weak.alias("weak"), *[F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
                       F.when(F.size(weak) > 0, F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.sha2("body", 256))).alias("doc"))
    rows = written(rows, "spans")
    parts = rows.where("doc is not null").dropDuplicates(["doc"]).select("doc", F.explode(F.concat("base", "weak")).alias("part"))
    parts = parts.select("doc", "part.*").withColumn("role", F.element_at(roles, F.col("kind") + 1))
    linked = _scoped(parts, scope).groupBy("doc").agg(F.collect_list(F.struct("start", "kind", "stop")).alias("linked"))
    # Documents without a candidate have no key to look up; they are spread over keys that nothing has.
    other = F.concat(F.lit("none "), F.pmod(F.xxhash64("doc_id"), F.lit(4096)).cast("string"))
    rows = rows.join(linked.withColumnRenamed("doc", "d"), F.coalesce("doc", other) == F.col("d"), "left")
    linked = F.coalesce("linked", F.array().cast("array<struct<start: bigint, kind: int, stop: bigint>>"))
    return rows.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                       _joined(F.concat("base", linked)).alias("spans"), F.size(linked).cast("long").alias("n_linked"))
