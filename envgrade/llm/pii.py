r"""Op 5: personal data by patterns, checksums and context words, in SQL functions only.

Patterns propose spans, validators confirm them (Luhn for cards, mod 97 for account numbers, ranges and digit
counts for the rest), and words near a span raise or lower its score. Base kinds (email, ip, card, phone) stay
whatever their score; added kinds (iban, ssn) need ``min_score``.

Matches are marked and the text is split at the marks; positions are prefix sums of the lengths of the parts, by
doubling steps. Stretches of a text with matches are cut from its fixed-width (UTF-32) bytes, which takes no longer at
the end of a text than at its front. So a text of n characters and m matches costs n + m log m, however many there are.
A row is handled alone, so there is no shuffle. The patterns start only where a run of their characters starts
(or where the previous match ended) and repeat possessively, so long runs of digits or letters cost linear time
and no stack; they find what the plain patterns find. The mark is a code point that is no character (U+FFFE); where a text
holds it, it is read as U+FFFD, in `redact` too if there is something to redact.

Rows: a null text is empty and gives no spans; repeated rows give equal results; an empty table gives no rows;
other columns of the input, of any name, are kept by `redact` and ignored by `find_spans`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envgrade.llm.common import table

# Kinds in the order that breaks ties between spans with one start.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = KINDS[:4]

LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
}
# A cheap test that every match passes.
HINTS = {
    "email": "contains({t}, '@')",
    "phone": "contains({t}, '+')",
    "ssn": "contains({t}, '-')",
}

# An even place counted from the right is doubled; a doubled digit over 9 counts its digit sum.
LUHN = (
    "aggregate(sequence(1, length({d})), 0, (a, i) -> a + if(i % 2 = 1, int(substr({d}, -i, 1)),"
    " int(substr('0246813579', int(substr({d}, -i, 1)) + 1, 1)))) % 10 = 0"
)
PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

CONTEXT = {
    "email": "mail|e-mail|contact|write to",
    "ip": r"\bip\b|address|host|server",
    "card": "card|visa|credit|debit|payment",
    "phone": "phone|call|tel|mobile|fax",
    "iban": "iban|account|bank|transfer",
    "ssn": r"\bssn\b|social security",
}
AGAINST = "version|example|order no|serial|isbn"
FIRST_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.3}
MIN_SCORE = 0.6
REACH = 40


def _quoted(pattern: str) -> str:
    return f"r'{pattern}'"


def _valid(kind: str, h: str) -> str:
    """SQL for whether a proposed match is confirmed."""
    if kind == "ip":
        return f"rlike({h}, {_quoted('^' + PART + '(?:[.]' + PART + '){3}$')})"
    if kind == "card":
        return LUHN.format(d=f"translate({h}, ' -', '')")
    if kind == "phone":
        return f"length(translate({h}, '+ ().-', '')) between 10 and 15"
    if kind == "iban":
        d = f"translate({h}, ' ', '')"
        c = f"substr(concat(substr({d}, 5), substr({d}, 1, 4)), i, 1)"
        step = f"if({c} between '0' and '9', (a * 10 + int({c})) % 97, (a * 100 + ascii({c}) - 55) % 97)"
        return f"aggregate(sequence(1, length({d})), 0, (a, i) -> {step}) = 1"
    return "true"


SPAN = "struct<kind: string, start: int, stop: int, score: double>"
MARK, INSTEAD = "\ufffe", "\ufffd"


def _scan(values: str, joined: str) -> str:
    """SQL for running totals of an array by doubling steps; ``joined`` combines x and y."""
    step = f"transform(a, (x, i) -> if(i >= shiftleft(1, k), {joined.format(x='x', y='a[i - shiftleft(1, k)]')}, x))"
    return f"aggregate(sequence(0, cast(ceil(log2(size({values}) + 1)) as int)), {values}, (a, k) -> {step})"


def _stretch(start: str, stop: str) -> str:
    """SQL for the text from ``start`` to ``stop``, from its UTF-32 bytes ``w``."""
    return f"decode(substring(w, 4 * ({start}) + 1, 4 * ({stop} - ({start}))), 'UTF-32')"


def _with_bytes(expression: str) -> str:
    """SQL with the bytes as a variable; read from the row, all of them would be copied at each use."""
    return f"transform(array(wide), w -> {expression})[0]"


def _parts(kind: str) -> str:
    """SQL for the text split around its matches: every second part is a match."""
    pattern = _quoted(PATTERNS[kind])
    hint = HINTS[kind].format(t="plain") if kind in HINTS else f"rlike(plain, {pattern})"
    return f"if({hint}, split(regexp_replace(plain, {pattern}, '{MARK}$0{MARK}'), '{MARK}', -1), array(''))"


def _spans(kind: str) -> str:
    """SQL for the confirmed spans of one kind: (kind, start, stop, score)."""
    parts, ends = f"parts_{kind}", f"ends_{kind}"
    near = f"lower({_stretch(f'greatest(0, {ends}[2 * nth] - {REACH})', f'least(chars, {ends}[2 * nth + 1] + {REACH})')})"
    score = (
        f"{FIRST_SCORE[kind]}D + if(rlike({near}, {_quoted(CONTEXT[kind])}), 0.3D, 0D)"
        f" - if(rlike({near}, {_quoted(AGAINST)}), 0.2D, 0D)"
    )
    span = f"named_struct('kind', '{kind}', 'start', {ends}[2 * nth], 'stop', {ends}[2 * nth + 1], 'score', {score})"
    places = f"sequence(0, size({parts}) div 2 - 1)"
    confirmed = f"filter({places}, nth -> {_valid(kind, f'{parts}[2 * nth + 1]')})"
    return f"if(size({parts}) > 1, {_with_bytes(f'transform({confirmed}, nth -> {span})')}, array())"


def _with_spans(rows: DataFrame) -> DataFrame:
    """Rows of (own, text) with plain, wide and spans, by start and then kind; positions count code points."""
    plain = F.translate(F.coalesce("text", F.lit("")), MARK, INSTEAD)
    rows = rows.select("own", "text", plain.alias("plain"))
    rows = rows.select("*", *[F.expr(_parts(k)).alias(f"parts_{k}") for k in KINDS])
    some = " or ".join(f"size(parts_{k}) > 1" for k in KINDS)
    lengths = "transform(parts_{0}, p -> char_length(p))"
    rows = rows.select(
        "*", F.expr(f"if({some}, encode(plain, 'UTF-32'), null)").alias("wide"), F.char_length("plain").alias("chars"),
        *[F.expr(lengths.format(k)).alias(f"lengths_{k}") for k in KINDS],
    )
    sums = {f"ends_{k}": F.expr(f"if(size(parts_{k}) > 1, {_scan(f'lengths_{k}', '{x} + {y}')}, array(0))") for k in KINDS}
    rows = rows.select("*", *[c.alias(n) for n, c in sums.items()])
    found = ", ".join(f"cast({_spans(kind)} as array<{SPAN}>)" for kind in KINDS)
    order = " ".join(f"when '{k}' then {i}" for i, k in enumerate(KINDS))
    kept = f"filter(concat({found}), p -> p.kind in ({', '.join(repr(k) for k in BASE)}) or p.score >= {MIN_SCORE})"
    by_place = (
        f"array_sort({kept}, (l, r) -> case when l.start <> r.start then l.start - r.start"
        f" else (case l.kind {order} end) - (case r.kind {order} end) end)"
    )
    spans = f"if(wide is not null, {by_place}, cast(array() as array<{SPAN}>))"
    return rows.select("own", "text", "plain", "wide", "chars", F.expr(spans).alias("spans"))


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and its spans (kind, start, stop, score)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("own"), F.col(f"`{text_col}`").alias("text"))
    return _with_spans(rows).select(F.col("own").alias("doc_id"), "spans")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Replace every span by its kind in brackets; of spans that overlap, the first is named and all are covered."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = _with_spans(docs.select(own.alias("own"), F.col(f"`{text_col}`").alias("text")))
    # What the spans up to each one cover; a span that starts beyond what those before it cover is named.
    reach = _scan("transform(spans, p -> p.stop)", "greatest({x}, {y})")
    rows = rows.select("*", F.expr(f"if(size(spans) > 0, {reach}, array(0))").alias("reach"))
    named = "filter(sequence(0, size(spans) - 1), i -> i = 0 or spans[i].start >= reach[i - 1])"
    rows = rows.select("*", F.expr(f"if(size(spans) > 0, {named}, array(0))").alias("named"))
    before = _stretch("if(i = 0, 0, reach[i - 1])", "spans[i].start")
    pieces = f"transform(named, i -> concat({before}, '[', upper(spans[i].kind), ']'))"
    masked = f"concat(array_join({pieces}, ''), {_stretch('reach[size(reach) - 1]', 'chars')})"
    out = F.expr(f"if(size(spans) > 0, {_with_bytes(masked)}, text)")
    return rows.select(*[
        out.alias(c) if c == text_col else F.col("own").getField(c).alias(c) for c in docs.columns
    ])


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_spans(table(spark, sf_dir, "documents"))
    base = f"filter(spans, p -> p.kind in ({', '.join(repr(k) for k in BASE)}))"
    joined = "array_join(transform({s}, p -> concat(p.kind, ':', p.start, ':', p.stop)), ',')"
    return found.select(
        "doc_id",
        *[F.expr(f"cast(size(filter(spans, p -> p.kind = '{k}')) as long)").alias(f"n_{k}") for k in BASE],
        F.sha2(F.expr(joined.format(s=base)), 256).alias("base_sha256"),
        F.expr(joined.format(s="spans")).alias("spans"),
    )
