"""Personal data spans, in DataFrame and SQL functions only.

Regular expressions propose spans, validators confirm them (Luhn for cards, mod-97 for bank account
numbers, part and digit ranges), and words near a span adjust its score.  Spans of the base kinds
(email, ip, card, phone) stay whatever their score; the added kinds need ``THRESHOLD``.

Spark's functions give matches without places.  ``split`` by the same expression gives the text between
them, so the running sum of both lengths gives the places, in code points.  The running sum is taken
over blocks of the root of the number of matches, so a text full of matches stays far from quadratic.

The expressions are the contract's, written so that Java's matcher neither recurses nor rescans: inner
repeats are possessive, and a match starts where a run of its characters starts (or the last match ended).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# a run of digits with single blanks or hyphens between them, taken whole
RUN = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){%d,%d}(?![ -]?[0-9])"
CARD = RUN % (15, 18)
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
# characters of an account number -> the countries whose numbers have that many
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _account_number() -> str:
    """Numbers of the exact length of their country, so that no word after one is taken in; other countries' numbers
    have any length, and end before a number of a known country."""
    exact = "|".join(f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}"
                     + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, countries in IBAN_LENGTHS.items())
    known = "|".join(IBAN_LENGTHS.values()).replace(" ", "|")
    apart = f"(?! (?:{exact})(?![A-Za-z0-9]))"
    other = f"(?!{known})[A-Z]{{2}}[0-9]{{2}}(?:{apart} ?[A-Z0-9]{{4}}){{2,7}}(?:{apart} ?[A-Z0-9]{{1,3}})?"
    return f"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{exact}|{other})(?![A-Za-z0-9])"


IBAN = _account_number()
SHORT_CARD = RUN % (12, 14)
NATIONAL_ID = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
LOCAL_PHONE = r"(?<![0-9+(-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])"

NEAR = 40  # characters on each side in which context words count
THRESHOLD = 0.7
# kind -> (expression, what must be in a text that has one, start score, gain by a passed check, gain by context, context words)
BASE = ["email", "ip", "card", "phone"]
KINDS = {
    "email": (EMAIL, "@", 0.8, 0.1, 0.1, r"\b(?:e-?mail|mail|contact|write|address)\b"),
    "ip": (IP, r"[0-9]\.[0-9]", 0.5, 0.3, 0.2, r"\b(?:ip|host|server|address|login)\b"),
    "card": (CARD, None, 0.4, 0.4, 0.2, r"\b(?:card|visa|master ?card|credit|debit|payment)\b"),
    "phone": (PHONE, r"\+[0-9]", 0.5, 0.3, 0.2, r"\b(?:phone|tel|call|mobile|fax)\b"),
    "iban": (IBAN, r"[A-Z]{2}[0-9]{2}", 0.3, 0.5, 0.2, r"\b(?:iban|account|bank|konto|compte|cuenta)\b"),
    "short_card": (SHORT_CARD, None, 0.2, 0.3, 0.4, r"\b(?:card|visa|master ?card|amex|credit|debit|payment)\b"),
    "national_id": (NATIONAL_ID, "-[0-9]{2}-", 0.2, 0.3, 0.4, r"\b(?:ssn|social security|tax id)\b"),
    "local_phone": (LOCAL_PHONE, r"[0-9]{3}[ .-][0-9]{4}", 0.2, 0.2, 0.4, r"\b(?:phone|tel|call|mobile|fax)\b"),
}


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Check digit of card numbers: from the right, every second digit doubled, digits summed, a multiple of ten."""
    def step(total: Column, pair: Column) -> Column:
        return total + pair
    digits = F.array_remove(F.split(F.reverse(_digits(value)), ""), "")
    doubled = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")))
    return F.aggregate(doubled, F.lit(0), step) % 10 == 0


def _mod97(value: Column) -> Column:
    """Bank account check: first four characters to the end, letters as 10 to 35, remainder 1 by 97; 15 to 34 characters."""
    plain = F.regexp_replace(value, " ", "")
    turned = F.array_remove(F.split(F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4)), ""), "")
    number = F.transform(turned, lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55))
    rest = F.aggregate(number, F.lit(0), lambda r, d: (r * F.when(d > 9, 100).otherwise(10) + d) % 97)
    return F.length(plain).between(15, 34) & (rest == 1)


def _parts_in_range(value: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+", "")
        return (F.length(bare) <= 2) | ((F.length(bare) == 3) & (bare <= "255"))
    return F.forall(F.split(value, r"\."), small)


def _digit_count(low: int, high: int):
    return lambda value: F.length(_digits(value)).between(low, high)


CHECKS = {
    "email": lambda value: F.lit(True),
    "ip": _parts_in_range,
    "card": _luhn,
    "phone": _digit_count(8, 15),
    "iban": _mod97,
    "short_card": _luhn,
    "national_id": lambda value: ~value.rlike("^(?:000|666|9)|-00-|-0000$"),
    "local_phone": lambda value: ~value.rlike(r"^\(?[01]"),
}


def _ends(lengths: str) -> Column:
    """Running sum of an array column of integers, by blocks of the root of its size."""
    return F.expr(f"""transform(sequence(0, size({lengths}.all) - 1), k ->
        aggregate(slice({lengths}.blocks, 1, k div {lengths}.step), 0, (a, x) -> a + x)
        + aggregate(slice({lengths}.all, (k div {lengths}.step) * {lengths}.step + 1, k % {lengths}.step + 1), 0, (a, x) -> a + x))""")


def find_spans(docs: DataFrame) -> DataFrame:
    """doc_id and ``spans``: an array of (kind, start, end, value, checked, score) by kind as in KINDS, then start;
    places in code points, end exclusive.

    Base kinds are as the contract has them: leftmost non-overlapping matches that pass their check.  Added
    kinds pass their check, reach THRESHOLD with their context, and overlap no base span.  A null or empty text
    has none.  One row per input row, repeated rows and null doc_ids included; other columns are dropped.
    """
    text = F.coalesce("text", F.lit(""))
    out = docs.select("doc_id", text.alias("t"))
    for kind, (pattern, needs, *_) in KINDS.items():
        hits = F.regexp_extract_all("t", F.lit(pattern), F.lit(0))
        if needs:
            hits = F.when(F.instr("t", "@") > 0 if needs == "@" else F.col("t").rlike(needs), hits)
        out = out.withColumn(f"{kind}_hits", hits)
    for kind, (pattern, *_) in KINDS.items():
        some = F.size(f"{kind}_hits") > 0
        between = F.split("t", pattern, -1)
        lengths = F.when(some, F.zip_with(F.slice(between, 1, F.size(f"{kind}_hits")), f"{kind}_hits", lambda b, h: F.length(b) + F.length(h)))
        out = out.withColumn(f"{kind}_all", lengths)
    for kind in KINDS:
        out = out.withColumn(f"{kind}_sums", F.expr(
            f"if({kind}_all IS NULL, null, struct({kind}_all AS all, cast(ceil(sqrt(size({kind}_all))) AS int) AS step))"))
        blocks = (f"transform(sequence(0, (size({kind}_sums.all) - 1) div {kind}_sums.step), "
                  f"b -> aggregate(slice({kind}_sums.all, b * {kind}_sums.step + 1, {kind}_sums.step), 0, (a, x) -> a + x))")
        out = out.withColumn(f"{kind}_sums", F.expr(
            f"if({kind}_sums IS NULL, null, struct({kind}_sums.all AS all, {kind}_sums.step AS step, {blocks} AS blocks))"))
        out = out.withColumn(f"{kind}_ends", F.when(F.col(f"{kind}_sums").isNotNull(), _ends(f"{kind}_sums")))
    for kind in KINDS:
        out = out.withColumn(kind, _scored(kind)).drop(f"{kind}_hits", f"{kind}_all", f"{kind}_sums", f"{kind}_ends")
    empty = F.expr("cast(array() as array<struct<kind string, start int, end int, value string, checked boolean, score double>>)")
    out = out.withColumn("base", F.concat(*(F.coalesce(F.filter(k, lambda s: s["checked"]), empty) for k in BASE)))
    added = [F.coalesce(F.filter(k, lambda s: s["checked"] & (s["score"] >= THRESHOLD)), empty) for k in KINDS if k not in BASE]
    out = out.withColumn("added", F.concat(*added))
    free = F.filter("added", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return out.select("doc_id", F.concat("base", free).alias("spans"))


def _scored(kind: str) -> Column:
    _, _, start_score, by_check, by_context, words = KINDS[kind]

    def span(value: Column, end: Column) -> Column:
        start = end - F.length(value)
        around = F.lower(F.substring("t", F.greatest(start - NEAR, F.lit(0)) + 1, F.least(start, F.lit(NEAR)) + F.length(value) + NEAR))
        checked = CHECKS[kind](value)
        score = F.lit(start_score) + F.when(checked, by_check).otherwise(-by_check) + F.when(around.rlike(words), by_context).otherwise(0.0)
        return F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), value.alias("value"),
                        checked.alias("checked"), F.round(score, 3).alias("score"))
    return F.when(F.col(f"{kind}_ends").isNotNull(), F.zip_with(f"{kind}_hits", f"{kind}_ends", span))


def summary(spans: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256 of their list kind:start:end, the list of all spans, and the list of
    their scores (in thousandths), which check and context words set."""
    def listed(found: Column) -> Column:
        return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    def of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(BASE))
    return spans.select("doc_id", *map(of, BASE), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
                        F.array_join(F.transform("spans", lambda s: F.round(s["score"] * 1000).cast("int").cast("string")), ",").alias("scores"))
