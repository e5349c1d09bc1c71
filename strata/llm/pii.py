"""Personal data: patterns propose, checksums confirm, context adjusts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.names import unused_names
from strata.llm.common import read_table, without

BASE_KINDS = ("email", "ip", "card", "phone")

# Each pattern finds the same spans as its plain form (in OP9_SQL). Possessive
# repeats keep the matcher from recursing on very long runs, and a match may
# only start where a run of its first class starts or the last match ended,
# which keeps the scan linear.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}

# Lengths of the registered countries' IBANs. By them an IBAN ends where its
# country says, whatever stands behind it.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|HR|LI|LV",
    22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG",
    25: "LY|PT|ST", 26: "IS|TR", 27: "BI|DJ|FR|GR|IT|MC|MR|SM", 28: "AL|AZ|BY|CY|DO|GT|HN|HU|LB|NI|PL|SV",
    29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU|YE", 31: "MT|SC", 32: "LC", 33: "RU",
}
# Its match is the first four characters and its group the whole proposal, so
# that a proposal may start within another one.
IBAN_HEAD = 4
IBAN_OF_COUNTRY = (
    r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2}\x20?[A-Z0-9])(?=((?:"
    + "|".join(rf"(?:{codes})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - IBAN_HEAD}}}" for n, codes in IBAN_LENGTHS.items())
    + r")(?![A-Za-z0-9])))[A-Z]{2}[0-9]{2}"
)

# Score before context: what the pattern and its checksum alone are worth.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.5, "iban": 0.8, "ssn": 0.3}
CONTEXT = {
    "email": r"mail|contact|write to",
    "ip": r"\bip\b|address|host|server",
    "card": r"card|visa|credit|payment|karte|carte|tarjeta",
    "phone": r"phone|tel|call|mobile|fax|m(?:ó|o)vil",
    "iban": r"iban|account|bank|konto|compte|cuenta",
    "ssn": r"ssn|social security",
}
CONTEXT_CHARS = 40
CONTEXT_BONUS = 0.2
#: Kinds beyond the base need this score; base spans always stay.
ACCEPT = 0.5

# A document without this character cannot hold the kind.
TRIGGER = {"email": "@", "phone": "+"}


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = _digits(value)

    def add(total: Column, i: Column) -> Column:
        x = digits.substr(-i, F.lit(1)).cast("int")
        twice = 2 * x
        return total + F.when(i % 2 == 1, x).when(twice > 9, twice - 9).otherwise(twice)

    whole = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0
    return F.when(F.length(digits).between(13, 19), whole).otherwise(F.lit(False))


def _mod97(value: Column) -> Column:
    plain = F.regexp_replace(value, r"\x20", "")
    turned = F.concat(plain.substr(F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def add(rest: Column, i: Column) -> Column:
        c = turned.substr(i, F.lit(1))
        code = F.ascii(c)
        return F.when(code < 65, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.when(
        F.length(plain).between(15, 34),
        F.aggregate(F.sequence(F.lit(1), F.length(plain)), F.lit(0), add) == 1,
    ).otherwise(F.lit(False))


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(
            F.split(value, r"\."),
            lambda p: F.coalesce(p.try_cast("decimal(38,0)") <= 255, F.lit(False)),
        )
    if kind == "card":
        return _luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    if kind == "iban":
        return _mod97(value)
    return F.lit(True)


def _located(kind: str, found: Column, between: Column, head: int | None = None) -> Column:
    """Spans of the matches: each starts after the pieces and matches before it.
    With ``head``, a match is only that many characters of its span."""
    zero = F.struct(
        F.lit(0).alias("at"),
        F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>").alias("all"),
    )

    def step(acc: Column, i: Column) -> Column:
        value = F.element_at(found, i)
        start = acc["at"] + F.length(F.element_at(between, i))
        end = start + F.length(value)
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), value.alias("value"))
        at = end if head is None else start + head
        return F.struct(at.alias("at"), F.array_append(acc["all"], span).alias("all"))

    spans = F.aggregate(F.sequence(F.lit(1), F.size(found)), zero, step, lambda acc: acc["all"])
    spans = F.when(F.size(found) > 0, spans).otherwise(zero["all"])
    return F.filter(spans, lambda s: _valid(kind, s["value"]))


def _apart(spans: Column) -> Column:
    """Of overlapping spans, in order of their starts, the leftmost stay."""
    return F.aggregate(spans, F.filter(spans, lambda s: F.lit(False)), lambda kept, s: F.when(
        (F.size(kept) == 0) | (F.try_element_at(kept, F.lit(-1))["end"] <= s["start"]), F.array_append(kept, s)
    ).otherwise(kept))


def _with_countries(ibans: Column, of_country: Column) -> Column:
    """IBANs by their country's length, and of the others those beside them."""
    sure = _apart(of_country)
    others = F.filter(ibans, lambda s: ~F.exists(
        sure, lambda c: (c["start"] < s["end"]) & (s["start"] < c["end"])
    ))
    return F.array_sort(F.concat(sure, others))


def find_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``pii``: array of (kind, start, end, score), by kind as in
    ``PATTERNS``, then start; code points, end exclusive.

    Per kind the leftmost non-overlapping matches, kept where their validator
    agrees (cards: 13 to 19 digits and Luhn; phones: 9 to 15 digits; addresses:
    parts up to 255; IBANs: mod 97). An IBAN of a registered country ends at
    that country's length; other codes take the longest run. Words near a span,
    before or behind it, raise its score; the kinds beyond the base need a score
    of ``ACCEPT``. Built-in functions
    only: one row stays one row and nothing is shuffled.

    A null or empty text has no spans. Repeated rows are treated alike. An
    input column named ``pii`` is replaced, all others are kept.
    """
    docs = without(docs, "pii")
    kept = [F.col(f"`{c}`") for c in docs.columns]
    text = F.coalesce(F.col(text_col), F.lit(""))
    nothing = F.array().cast("array<string>")
    # A prefix that no column of the caller's has.
    (own,) = unused_names(1, docs)
    own += "_"
    found = {}
    for kind, pattern in PATTERNS.items():
        hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        found[f"{own}found_{kind}"] = (
            F.when(F.contains(text, F.lit(TRIGGER[kind])), hits).otherwise(nothing)
            if kind in TRIGGER else hits
        )
    found[f"{own}found_country"] = F.regexp_extract_all(text, F.lit(IBAN_OF_COUNTRY), F.lit(1))
    df = docs.select(*kept, *[c.alias(n) for n, c in found.items()])
    df = df.withColumns({
        f"{own}between_{kind}": F.when(F.size(f"{own}found_{kind}") > 0, F.split(text, pattern, -1)).otherwise(nothing)
        for kind, pattern in [*PATTERNS.items(), ("country", IBAN_OF_COUNTRY)]
    })
    df = df.withColumns({
        f"{own}spans_{kind}": _located(kind, F.col(f"{own}found_{kind}"), F.col(f"{own}between_{kind}"))
        for kind in PATTERNS
    } | {f"{own}spans_country": _located("iban", F.col(f"{own}found_country"), F.col(f"{own}between_country"), IBAN_HEAD)})
    df = df.withColumn(f"{own}spans_iban", F.when(
        F.size(f"{own}spans_country") > 0, _with_countries(F.col(f"{own}spans_iban"), F.col(f"{own}spans_country"))
    ).otherwise(F.col(f"{own}spans_iban")))

    def scored(kind: str) -> Column:
        def score(s: Column) -> Column:
            start = F.greatest(F.lit(0), s["start"] - CONTEXT_CHARS)
            before = F.lower(text.substr(start + 1, s["start"] - start))
            behind = F.lower(text.substr(s["end"] + 1, F.lit(CONTEXT_CHARS)))
            near = before.rlike(CONTEXT[kind]) | behind.rlike(CONTEXT[kind])
            bonus = F.when(near, CONTEXT_BONUS).otherwise(0.0)
            return F.struct(
                s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                F.least(F.lit(1.0), F.lit(SCORES[kind]) + bonus).alias("score"),
            )

        spans = F.transform(F.col(f"{own}spans_{kind}"), score)
        return spans if kind in BASE_KINDS else F.filter(spans, lambda s: s["score"] >= ACCEPT)

    return df.select(*kept, F.concat(*[scored(kind) for kind in PATTERNS]).alias("pii"))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of ``find_pii`` replaced by its kind in angle
    brackets; overlapping spans become one, named after the first. Null texts
    stay null."""
    df = find_pii(docs, text_col)
    text = F.col(text_col)
    spans = F.array_sort(F.transform(
        "pii", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"))
    ))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = F.array_append(
            F.array_append(acc["out"], text.substr(acc["at"] + 1, s["start"] - acc["at"])),
            F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")),
        )
        return F.struct(
            F.greatest(acc["at"], -s["back"]).alias("at"),
            F.when(s["start"] >= acc["at"], fresh).otherwise(acc["out"]).alias("out"),
        )

    def finish(acc: Column) -> Column:
        return F.concat(F.array_join(acc["out"], ""), text.substr(acc["at"] + 1, F.length(text)))

    masked = F.when(F.size("pii") > 0, F.aggregate(spans, zero, step, finish)).otherwise(text)
    return df.select(*[
        masked.alias(c) if c == text_col else F.col(f"`{c}`") for c in df.columns if c != "pii"
    ])


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def _of(kind: str) -> Column:
    return F.filter("pii", lambda s: s["kind"] == kind)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = find_pii(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE_KINDS))
    return df.select(
        "doc_id",
        *[
            F.size(_of(kind)).cast("long").alias(f"n_{kind}")
            for kind in BASE_KINDS
        ],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("pii")).alias("spans"),
    )


# The patterns in their plain form. A span's start is the length of all pieces
# and matches before it.
_PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}\b",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
}
_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
_CHECK = {
    "email": "true",
    "ip": "len(list_filter(string_split(v, '.'), lambda p: coalesce(try_cast(p AS HUGEINT), 256) > 255)) = 0",
    "card": f"length({_DIGITS}) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length({_DIGITS}) + 1),"
    f" lambda i: CASE WHEN i % 2 = 1 THEN substr({_DIGITS}, -i, 1)::INT"
    f" ELSE list_sum(list_transform(string_split((2 * substr({_DIGITS}, -i, 1)::INT)::VARCHAR, ''), lambda d: d::INT)) END)) % 10 = 0",
    "phone": f"length({_DIGITS}) BETWEEN 9 AND 15",
    "iban": "length(replace(v, ' ', '')) BETWEEN 15 AND 34 AND list_reduce(list_prepend(0, list_transform(string_split("
    "substr(replace(v, ' ', ''), 5) || substr(replace(v, ' ', ''), 1, 4), ''),"
    " lambda c: CASE WHEN ascii(c) < 65 THEN ascii(c) - 48 ELSE ascii(c) - 55 END)),"
    " lambda a, b: CASE WHEN b < 10 THEN (a * 10 + b) % 97 ELSE (a * 100 + b) % 97 END) = 1",
    "ssn": "regexp_matches(lower(substr(t, greatest(0, s - 40) + 1, s - greatest(0, s - 40))), 'ssn|social security')",
}


def _kind_sql(k: int, kind: str) -> str:
    pattern = _PLAIN[kind]
    return f"""
  SELECT r, {k} AS k, '{kind}' AS kind, s, s + length(v) AS e FROM (
    SELECT r, t, v,
           (coalesce(list_sum(list_transform(p[1:i], lambda x: length(x))), 0)
            + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::BIGINT AS s
    FROM (SELECT r, t, m, p, unnest(m) AS v, unnest(range(1, len(m) + 1)) AS i FROM (
      SELECT r, t, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS p FROM d)))
  WHERE {_CHECK[kind]}"""


OP9_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({" UNION ALL ".join(_kind_sql(k, kind) for k, kind in enumerate(_PLAIN))}),
per AS (
  SELECT r, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
         count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
         coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s) FILTER (k < 4), '') AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s) AS spans
  FROM spans GROUP BY r
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (r)
"""
