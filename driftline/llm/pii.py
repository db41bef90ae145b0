"""Personal data in texts: patterns propose spans, checksums confirm them, nearby words move their score.

Column expressions only. All places are code points, the end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "iban", "secret")
BASE_KINDS = KINDS[:4]

# The patterns find what the plain ones find, without going over a long run of
# letters or digits again from each place in it: a match begins at the start of
# such a run, or where the last match ended.
#   email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip    [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   card  [0-9]([\x20-]?[0-9])+ of 14 to 19 digits: a whole run, so shorter and longer ones are not proposed
#   phone \+[0-9][\x20().0-9-]+[0-9]
#   iban  the first four characters only, at every place that eleven more follow; the end is found by the checksum
#   secret  a run of 20 to 200 letters, digits and signs of keys, both a letter and a digit among them
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9]|[0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\x20?[A-Z0-9]){11})",
    "secret": r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/=-]*+[0-9])(?=[0-9_+/=-]*+[A-Za-z])[A-Za-z0-9_+/=-]{20,200}+(?![A-Za-z0-9_+/=-])",
}
# What every match holds: texts without it are not searched.
MARKS = {"email": "@", "phone": "+"}

# Letters and digits of an account number, each of which a blank may precede.
ACCOUNT = r"^[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}"
ACCOUNT_LEAST, ACCOUNT_MOST = 15, 34

CONTEXT_CHARS = 40
# Score of a confirmed span, and what words close to it, on either side, add or take away.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "secret": 0.4}
# Spans of added kinds below it are dropped: a run of letters and digits counts where words say that it is a key.
MIN_SCORE = 0.5
CONTEXT = {
    "email": (r"mail|contact|write|reach|kontakt|correo|courriel", r"example|user"),
    "ip": (r"\bip\b|address|host|server|client|login|adresse", r"version|release|section|chapter|v\.?$"),
    "card": (r"card|visa|master|credit|debit|pay|karte|carte|tarjeta", r"order|serial|isbn|tracking"),
    "phone": (r"phone|tel|call|mobile|cell|fax|whatsapp|anruf|llam", r"order|serial|isbn|tracking"),
    "iban": (r"iban|account|bank|transfer|konto|compte|cuenta", r"serial|tracking"),
    "secret": (r"key|token|secret|passw|pwd|auth|bearer|credential|schlüssel|clé|clave|contraseña", r"commit|sha|md5|hash|digest|checksum|uuid|http"),
}
CONTEXT_STEP = 0.2


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 1, F.element_at(F.array(*map(F.lit, [0, 2, 4, 6, 8, 1, 3, 5, 7, 9])), d.cast("int") + 1)).otherwise(d.cast("int")),
    )
    return F.aggregate(doubled, F.lit(0), lambda total, d: total + F.coalesce(d, F.lit(0))) % 10 == 0


def mod97(text: Column) -> Column:
    """Remainder of an account number by 97, its first four characters put last and letters counted from 10."""
    plain = F.regexp_replace(text, " ", "")
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    return F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda rest, c: F.when(c == "", rest)
        .when(c.between("0", "9"), (rest * 10 + F.ascii(c) - 48) % 97)
        .otherwise((rest * 100 + F.ascii(c) - 55) % 97),
    )


def confirmed(kind: str, found: Column) -> Column:
    """Whether the checks of the kind hold for a match."""
    digits = _digits(found)
    if kind == "ip":
        return found.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$")
    if kind == "card":
        return F.length(digits).between(14, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def account_length(ahead: Column, run: Column) -> Column:
    """Characters of the longest start of ``run`` that ends in ``ahead`` there and is an account number; NULL if none does.

    Capital words and numbers behind a number look like parts of it, so each end is tried.
    """
    lengths = F.sequence(F.greatest(F.length(run), F.lit(ACCOUNT_LEAST)), F.lit(ACCOUNT_LEAST), F.lit(-1))

    def ends(length: Column) -> Column:
        part = F.substr(run, F.lit(1), length)
        at_end = F.substr(ahead, length, F.lit(2)).rlike(r"^[A-Z0-9](?![A-Za-z0-9])")
        return at_end & F.length(F.regexp_replace(part, " ", "")).between(ACCOUNT_LEAST, ACCOUNT_MOST) & (mod97(part) == 1)

    return F.get(F.filter(lengths, ends), F.lit(0))


def score(kind: str, before: Column, behind: Column) -> Column:
    """Between 0 and 1: by the kind, and by words of the 40 characters on each side, up to the next match."""
    near = F.concat(F.substring(before, -CONTEXT_CHARS, CONTEXT_CHARS), F.lit(" "), F.substring(F.coalesce(behind, F.lit("")), 1, CONTEXT_CHARS))
    near = F.lower(near)
    more, less = CONTEXT[kind]
    moved = F.lit(SCORES[kind]) + F.when(near.rlike(more), CONTEXT_STEP).otherwise(0.0) - F.when(near.rlike(less), CONTEXT_STEP).otherwise(0.0)
    return F.round(F.least(F.greatest(moved, F.lit(0.0)), F.lit(1.0)), 3)


_SPAN = "array<struct<start:int,kind_no:int,end:int,kind:string,score:double>>"


def _spans_of(kind: str, text: Column) -> Column:
    """Confirmed spans of one kind in order: the pieces between matches and the matches add up to their places."""
    pattern = PATTERNS[kind]
    gaps = F.split(text, pattern, -1)
    pieces = F.zip_with(
        gaps,
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, found: F.struct(gap.alias("gap"), found.alias("found")),
    )
    pieces = F.zip_with(pieces, F.slice(gaps, 2, F.size(gaps)), lambda piece, behind: piece.withField("behind", behind))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))

    def step(state: Column, piece: Column) -> Column:
        begin = state["at"] + F.length(piece["gap"])
        end = begin + F.length(piece["found"])
        span = F.struct(
            begin.alias("start"),
            F.lit(KINDS.index(kind)).alias("kind_no"),
            end.alias("end"),
            F.lit(kind).alias("kind"),
            score(kind, piece["gap"], piece["behind"]).alias("score"),
        )
        # The last piece has no match after it.
        good = piece["found"].isNotNull() & confirmed(kind, piece["found"])
        return F.struct(
            F.coalesce(end, state["at"]).alias("at"),
            F.when(good, F.concat(state["spans"], F.array(span).cast(_SPAN))).otherwise(state["spans"]).alias("spans"),
        )

    found = F.aggregate(pieces, start, step, lambda state: state["spans"])
    there = text.contains(MARKS[kind]) & text.rlike(pattern) if kind in MARKS else text.rlike(pattern)
    return F.when(there, found).otherwise(F.array().cast(_SPAN))


def _accounts(text: Column) -> Column:
    """Confirmed spans of account numbers in order, none within another.

    Starts are proposed first. Each step is a list of its own, so nothing is worked again for every end tried.
    """
    ahead = F.transform(_spans_of("iban", text), lambda s: F.struct(s.alias("span"), F.substr(text, s["start"] + 1, F.lit(2 * ACCOUNT_MOST)).alias("ahead")))
    cut = F.transform(ahead, lambda p: F.struct(p["span"].alias("span"), p["ahead"].alias("ahead"), F.regexp_extract(p["ahead"], ACCOUNT, 0).alias("run")))
    known = F.transform(cut, lambda p: F.struct(p["span"].alias("span"), account_length(p["ahead"], p["run"]).alias("length")))

    def step(spans: Column, p: Column) -> Column:
        begin = p["span"]["start"]
        apart = F.coalesce(begin >= F.get(spans, F.size(spans) - 1)["end"], F.lit(True))
        span = p["span"].withField("end", begin + p["length"])
        return F.when(p["length"].isNotNull() & apart, F.concat(spans, F.array(span).cast(_SPAN))).otherwise(spans)

    return F.aggregate(known, F.array().cast(_SPAN), step)


def spans_of(text: Column, min_score: float) -> Column:
    """All confirmed spans, by start, then kind; those of the first four kinds whatever their score."""
    added = F.filter(F.concat(_accounts(text), _spans_of("secret", text)), lambda span: span["score"] >= min_score)
    return F.array_sort(F.concat(*[_spans_of(kind, text) for kind in BASE_KINDS], added))


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """``id, text, spans``: all confirmed spans of each text with kind and score, by start, then kind.

    Each row is treated for itself, so repeated rows and NULL ids give a row each. A
    NULL or empty text has no spans. Kinds are searched one by one, so spans of
    different kinds may overlap; of one kind they do not. Spans of the first four
    kinds are always kept; ``min_score`` bounds the others. Other columns are not
    looked at.
    """
    named = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    return named.withColumn("spans", spans_of(F.coalesce(F.col("text"), F.lit("")), min_score))


def written(spans: Column) -> Column:
    """``kind:start:end`` of spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        apart = span["start"] >= state["at"]
        kept = F.concat(
            state["out"],
            F.substr(text, state["at"] + 1, span["start"] - state["at"]),
            F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]")),
        )
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(apart, kept).otherwise(state["out"]).alias("out"),
        )

    replaced = F.aggregate(spans, start, step, lambda state: F.concat(state["out"], F.substr(text, state["at"] + 1)))
    return F.when(F.size(spans) > 0, replaced).otherwise(text)


def mask(docs: DataFrame, *, text_col: str = "text", length_col: str = "n_chars", min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` with every span masked and, where there is such a column, the new number of characters.

    Texts without spans and NULL texts stay as they are, and so does their length.
    Every row is masked for itself, repeated or without an id. The columns are
    those of ``docs``, whatever their names.
    """
    # The row stands apart from what is worked out for it, so no name can clash.
    row = docs.select(F.struct("*").alias("doc"))
    text = F.col(f"doc.`{text_col}`")
    found = row.withColumn("spans", spans_of(F.coalesce(text, F.lit("")), min_score)).withColumn("masked", masked(text, F.col("spans")))
    columns = {text_col: F.col("masked")}
    if length_col in docs.columns:
        length = F.length("masked").cast(docs.schema[length_col].dataType)
        columns[length_col] = F.when(F.size("spans") > 0, length).otherwise(F.col(f"doc.`{length_col}`"))
    return found.select(*[columns.get(name, F.col(f"doc.`{name}`")).alias(name) for name in docs.columns])


def digest(found: DataFrame) -> DataFrame:
    """Counts, digest, list and scores of the spans of each row."""
    base = F.filter("spans", lambda s: s["kind_no"] < len(BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        *[name for name in found.columns if name not in ("text", "spans")],
        *map(count, BASE_KINDS),
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
        count("iban"),
        count("secret"),
        F.size("spans").cast("long").alias("n_spans"),
        F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )
