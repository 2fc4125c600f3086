"""Secret scans: spans of credentials in texts, by patterns and by sliding-window entropy.

DataFrame functions only; no shuffle, one pass over the rows.

Base kinds are regular expressions, leftmost and non-overlapping per kind. The method adds kind
``entropy``: candidate strings (long runs of key characters with a digit and a letter) get the
Shannon entropy of every window of ``WINDOW`` characters, kept by incremental counts: one character
enters, one leaves, and the sum of c * log2(c) changes by their two terms. A candidate whose best
window reaches the limit of its character class is a span, unless the allow-list knows it
(UUIDs, checksums of packages, paths, placeholders) or a base span covers part of it. The limit of a
class is the expected entropy of a random window less ``MARGIN``. A path is a candidate whose segments
are all names, however many slashes it has.
"""

from __future__ import annotations

from math import comb, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "entropy")

# The method's own parameters.
WINDOW = 20
MARGIN = 0.35  # bits per character below the expected entropy; about 2.5 standard deviations
# Symbols of a class that is not hexadecimal, by its first pattern that fits; marks alone make no class.
CLASSES = ((r"^[a-z0-9+/_=-]+$", 36), (r"^[A-Z0-9+/_=-]+$", 32), (r"^[A-Za-z0-9]+$", 62), (r"", 64))
HEX_LIMIT = 3.0  # bits per character
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^sha(256|384|512)-",
    r"(?i)example|sample|placeholder|xxxx|1234567890",
)
# Paths and names: the segments between marks, all of which are names.
MARKS = r"[+/_=-]"
NAME = r"^(?:[A-Z]?[a-z]{1,15}[0-9]{0,4}|[A-Z]{1,15}[0-9]{0,4}|[0-9]{0,8})$"

_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _spans(text: Column, pattern: str, kind: int, keep=lambda match: F.lit(True)) -> Column:
    """(start, kind, end, match) of all matches, in order. The pieces between matches give the positions."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    pairs = F.zip_with(pieces, matches, lambda piece, match: F.struct(F.length(piece).alias("skip"), match.alias("match")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int,match:string>>").alias("out"))

    def step(have: Column, pair: Column) -> Column:
        begin = have["at"] + pair["skip"]
        end = begin + F.coalesce(F.length(pair["match"]), F.lit(0))
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), pair["match"].alias("match"))
        hit = pair["match"].isNotNull() & keep(pair["match"])
        return F.struct(end.alias("at"), F.when(hit, F.array_append(have["out"], span)).otherwise(have["out"]).alias("out"))

    return F.aggregate(pairs, start, step, lambda have: have["out"])


def _guarded(test: Column, spans: Column) -> Column:
    """Most texts have no match: look before taking them apart."""
    return F.when(test, spans).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int,match:string>>"))


def best_entropy(text: Column) -> Column:
    """Highest Shannon entropy, in bits, of any WINDOW consecutive characters (all in ALPHABET)."""
    codes = F.transform(F.split(text, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    # F.split(text, "") ends with no empty string; a zero-width split of n characters gives n.
    term = lambda n: F.when(n > 1, n * F.log2(n)).otherwise(F.lit(0.0))
    start = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET)).alias("n"),
        F.lit(0.0).alias("total"),
        F.lit(0.0).alias("best"),
        F.lit(0).alias("seen"),
        codes.alias("codes"),
    )

    def step(have: Column, code: Column) -> Column:
        full = have["seen"] >= WINDOW
        out = F.when(full, F.get(have["codes"], have["seen"] - WINDOW)).otherwise(F.lit(-1))
        n_out = F.coalesce(F.get(have["n"], F.when(out >= 0, out)), F.lit(0))
        n_in = F.get(have["n"], code) - F.when(out == code, F.lit(1)).otherwise(F.lit(0))
        total = have["total"] + F.when(full, term(n_out - 1) - term(n_out)).otherwise(F.lit(0.0)) + term(n_in + 1) - term(n_in)
        counts = F.transform(have["n"], lambda n, i: n + F.when(i == code, 1).otherwise(0) - F.when(i == out, 1).otherwise(0))
        bits = F.when(have["seen"] >= WINDOW - 1, F.log2(F.lit(float(WINDOW))) - total / WINDOW).otherwise(F.lit(0.0))
        return F.struct(
            counts.alias("n"), total.alias("total"), F.greatest(have["best"], bits).alias("best"), (have["seen"] + 1).alias("seen"), have["codes"].alias("codes")
        )

    return F.aggregate(codes, start, step, lambda have: have["best"])


def expected_entropy(symbols: int) -> float:
    """Mean Shannon entropy, in bits, of WINDOW characters drawn evenly from so many symbols."""
    p = 1 / symbols
    return log2(WINDOW) - symbols / WINDOW * sum(comb(WINDOW, c) * p**c * (1 - p) ** (WINDOW - c) * c * log2(c) for c in range(2, WINDOW + 1))


def _secret_like(match: Column) -> Column:
    """Digit and letter, not allowed, and enough entropy for its class; cheap tests first."""
    known = match.rlike(MARKS) & F.forall(F.split(match, MARKS, -1), lambda segment: segment.rlike(NAME))
    for pattern in ALLOWED:
        known = match.rlike(pattern) | known
    mixed = match.rlike("[0-9]") & match.rlike("[A-Za-z]")
    limit = F.when(match.rlike("^[0-9a-fA-F]+$"), F.lit(HEX_LIMIT))
    for pattern, symbols in CLASSES:
        limit = limit.when(match.rlike(pattern), F.lit(expected_entropy(symbols) - MARGIN))
    return F.when(mixed & ~known, best_entropy(match) >= limit).otherwise(F.lit(False))


def secret_spans(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """All input columns and ``secrets``: array of (start, kind, end), sorted by start, then kind.

    Kinds are numbers into KINDS; offsets count code points, end exclusive. A NULL or empty text has
    an empty array. Texts of any length are scanned whole; equal rows get equal results. An input
    column named ``secrets`` is replaced.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    small = F.lower(text)
    named = F.lit(False)
    for word in ASSIGN_WORDS:
        named = named | small.contains(word)
    base = F.concat(
        # A match below the length is dropped, but what it took is not searched again.
        _guarded(named, _spans(text, ASSIGN, 0, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 8)),
        _guarded(text.contains("AKIA"), _spans(text, ACCESS, 1)),
        _guarded(text.rlike(HEX), _spans(text, HEX, 2)),
    )
    mixed = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])" + CANDIDATE
    found = _guarded(text.rlike(mixed), _spans(text, CANDIDATE, 3, _secret_like))
    plain = lambda spans: F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"]))
    out = docs.withColumn("secrets", plain(base)).withColumn("_found", plain(found))
    free = F.filter("_found", lambda s: ~F.exists("secrets", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return out.withColumn("secrets", F.array_sort(F.concat("secrets", free)).cast(_SPAN)).drop("_found")


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def mask_secrets(docs: DataFrame, text_column: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """The input with every span replaced by ``mask``; overlapping spans give one mask.

    All other columns stay as they are, whatever their names. NULL and empty texts stay, an empty
    table stays empty.
    """
    # The input's columns lie in one, so that none of them can clash with those of the scan.
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_column).cast("string").alias("_text"))
    out = secret_spans(packed, "_text")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(have: Column, span: Column) -> Column:
        plain = F.substring(F.col("_text"), have["at"] + 1, span["start"] - have["at"])
        more = F.when(span["start"] >= have["at"], F.concat(have["out"], F.array(plain, F.lit(mask)))).otherwise(have["out"])
        return F.struct(F.greatest(have["at"], span["end"]).alias("at"), more.alias("out"))

    rebuilt = F.aggregate("secrets", start, step, lambda have: F.concat(F.array_join(have["out"], ""), F.substring(F.col("_text"), have["at"] + 1, F.length("_text"))))
    masked = F.when(F.size("secrets") > 0, rebuilt).otherwise(F.col("_text"))
    return out.select(*[(masked if c == text_column else F.col("row").getField(c)).alias(c) for c in docs.columns])


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans) per document."""
    out = secret_spans(docs.select(id_column, text_column), text_column)
    of = lambda k: F.filter("secrets", lambda s: s["kind"] == k)
    return out.select(
        id_column,
        *[F.size(of(k)).cast("long").alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(spans_text(F.filter("secrets", lambda s: s["kind"] < 3)).cast("binary"), 256).alias("base_sha256"),
        spans_text(F.col("secrets")).alias("spans"),
    )
