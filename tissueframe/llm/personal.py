"""Personal data in texts: patterns propose, checksums confirm, words nearby decide. DataFrame operations only.

Base spans (email, address, card, phone) are those of the contract. On top come
``iban`` (an account number whose mod-97 checksum holds), ``ssn`` (three, two and four
digits) and ``local`` (a phone number without a country code). Every span has a score in
hundredths: what its pattern is worth, more where a checksum confirms it, more where a word
that names its kind stands within ``NEAR`` code points before or behind it, and less where
a word that names something else does. Base spans stay at any score; the others from
``LEAST_SCORE`` on, if no base span and no span of an earlier kind overlaps them.
``n_sure`` counts the spans from ``LEAST_SCORE`` on.

Patterns are possessive and begin at the start of a run of their characters (or where
the match before ended), which finds the same matches in linear time and constant stack.
Positions come from the pieces between matches, a running sum over the matches of a text.

Defined cases: a null or empty text has no span; every row is judged on its own, so
repeated rows and ids give equal rows; words nearby reach as far as the neighbouring matches of the same
kind; positions count code points, ends exclusive; texts of any length are taken whole; of the
input only ``doc_id`` and ``text`` are read, other columns of any name do not matter; an empty
table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tissueframe.plans.lineage import store

# Fixed values of the contract, with possessive quantifiers: kind, pattern.
EMAIL = "(?:(?<![A-Za-z0-9._%+-])|\\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++"
IP = "(?<![0-9])[0-9]++(?:\\.[0-9]++){3}"
CARD = "[0-9](?:[\\x20-]?[0-9])++"
PHONE = "\\+[0-9][\\x20().0-9-]+[0-9]"
#: The added kinds.
IBAN = "[A-Z]{2}[0-9]{2}(?:\\x20?[A-Z0-9]{4}){2,7}(?:\\x20?[A-Z0-9]{1,3})?"
SSN = "[0-9]{3}-[0-9]{2}-[0-9]{4}"
LOCAL = "\\(?[0-9][\\x20().0-9-]*[0-9]"

KINDS = (
    ("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE), ("iban", IBAN), ("ssn", SSN), ("local", LOCAL),
)
BASE = 4
#: Texts without a match of this have no span of the kind; cheaper than taking all short matches apart.
_PRESENT = {"card": "[0-9](?:[\\x20-]?[0-9]){13}", "local": "[0-9][\\x20().0-9-]{5,}[0-9]"}

_DATE = "^(?:[0-9]{4}[.-][0-9]{1,2}[.-][0-9]{1,2}|[0-9]{1,2}[.-][0-9]{1,2}[.-][0-9]{4})$"

#: Worth of the pattern (with its checksum, if it has one), in hundredths.
WORTH = {"email": 80, "ip": 55, "card": 75, "phone": 60, "iban": 90, "ssn": 35, "local": 30}
NAMED, OTHER = 35, 30
LEAST_SCORE = 60
NEAR = 40
#: Words that name a kind, and words that name other numbers.
NAMES = {
    "email": "e-?mail|contact|write to|courriel",
    "ip": "ip|host|address|server|login",
    "card": "card|visa|mastercard|amex|credit|debit|karte|carte",
    "phone": "phone|tel|mobile|cell|call|fax|whatsapp|telefon|téléphone",
    "iban": "iban|account|bank|konto|compte",
    "ssn": "ssn|social security|taxpayer",
    "local": "phone|tel|mobile|cell|call|fax|whatsapp|telefon|téléphone",
}
OTHERS = "version|isbn|issn|order|invoice|serial|build|release|chapter|section"

_LAST = (1 << 63) - 1


def _word(words: str) -> str:
    return f"(?iu)(?<![\\p{{L}}0-9])(?:{words})(?![\\p{{L}}0-9])"


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether up to 20 digits pass the Luhn check."""
    padded = F.lpad(digits, 20, "0")
    doubled = F.translate(padded, "0123456789", "0246813579")  # twice the digit, the sum of its digits
    total = F.lit(0)
    for at in range(1, 21):
        total = total + F.substring(doubled if at % 2 else padded, at, 1).cast("int")
    return total % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number without spaces leaves 1 by 97, its first four characters moved behind and letters read as 10 to 35."""
    moved = F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4))
    rest = F.aggregate(
        F.split(moved, ""), F.lit(0),
        lambda r, c: F.when(c == "", r).when(c.rlike("[0-9]"), (r * 10 + c.cast("int")) % 97).otherwise((r * 100 + F.ascii(c) - 55) % 97),
    )
    return rest == 1


def _good(kind: str, value: Column, before: Column, behind: Column) -> Column:
    """Whether a match is a span of its kind, apart from its score."""
    digits = digits_of(value)
    if kind == "ip":
        return F.forall(F.split(value, "\\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.substring(F.concat(F.lit("000"), p), -3, 3).cast("int") <= 255))
    if kind == "card":
        return F.length(digits).between(14, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    alone = ~before.rlike("[\\p{L}0-9_+]$") & ~behind.rlike("^[\\p{L}0-9_]")
    if kind == "iban":
        account = F.regexp_replace(value, " ", "")
        return alone & F.length(account).between(15, 34) & mod97(account)
    if kind == "ssn":
        area = F.substring(value, 1, 3)
        return alone & ~area.isin("000", "666") & (area < "900") & (F.substring(value, 5, 2) != "00") & (F.substring(value, 8, 4) != "0000")
    if kind == "local":
        return alone & ~before.rlike("[.,:/#-]$") & ~behind.rlike("^[-/:]|^[.,][0-9]") & F.length(digits).between(7, 11) & ~value.rlike(_DATE)
    return F.lit(True)


def _score(kind: str, before: Column, behind: Column) -> Column:
    near = F.concat(before, F.lit(" "), behind)
    named = F.when(near.rlike(_word(NAMES[kind])), NAMED).otherwise(0)
    other = F.when(near.rlike(_word(OTHERS)), OTHER).otherwise(0)
    return F.least(F.lit(WORTH[kind]) + named - other, F.lit(100))


def _pieces(at: int) -> tuple[Column, Column]:
    """Matches of one kind in order, and the pieces of text before, between and behind them; null where there is none."""
    kind, pattern = KINDS[at]
    some = F.col("text").rlike(_PRESENT.get(kind, pattern))
    found = F.when(some, F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    return found.alias(f"_m{at}"), F.when(some, F.split("text", pattern, -1)).alias(f"_g{at}")


def _hits(at: int) -> Column:
    """Of each match: gap before, size, whether it is a span, and its score."""
    kind, gaps = KINDS[at][0], f"_g{at}"

    def judge(value: Column, i: Column) -> Column:
        before, behind = F.right(F.get(gaps, i), F.lit(NEAR)), F.left(F.get(gaps, i + 1), F.lit(NEAR))
        good = _good(kind, value, before, behind)
        return F.struct(
            F.lit(at).alias("kind"), F.length(F.get(gaps, i)).alias("gap"), F.length(value).alias("size"),
            good.alias("good"), F.when(good, _score(kind, before, behind)).alias("score"),
        )

    return F.coalesce(F.transform(f"_m{at}", judge), F.array().cast("array<struct<kind:int,gap:int,size:int,good:boolean,score:int>>"))


def find_personal(docs: DataFrame, least: int = LEAST_SCORE) -> DataFrame:
    """One row per document: counts by kind, the digest of the base spans, all spans and their scores.

    ``spans`` lists ``kind:start:end`` by start and then kind, comma-joined; ``scores`` lists
    their scores in the same order.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", *[c for k in range(len(KINDS)) for c in _pieces(k)])
    rows = rows.select("doc_id", F.concat(*[_hits(k) for k in range(len(KINDS))]).alias("hits"))
    rows = store(rows.select("doc_id", F.monotonically_increasing_id().alias("_row"), F.when(F.exists("hits", lambda h: h["good"]), F.col("hits")).alias("hits")), "personal-hits")
    hits = rows.select("_row", F.posexplode("hits").alias("_at", "_hit")).select("_row", "_at", "_hit.*")
    upto = Window.partitionBy("_row", "kind").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    spans = hits.withColumn("end", F.sum((F.col("gap") + F.col("size")).cast("long")).over(upto)).withColumn("start", F.col("end") - F.col("size"))
    spans = spans.where("good").where((F.col("kind") < BASE) | (F.col("score") >= least))
    # A span of an earlier kind overlaps if one that begins before reaches in, or one begins inside.
    earlier, by = F.lit(False), Window.partitionBy("_row")
    for kind in range(BASE, len(KINDS)):
        blocking = F.col("kind") < kind
        reach = F.max(F.when(blocking, F.col("end"))).over(by.orderBy("start").rangeBetween(Window.unboundedPreceding, 0))
        following = F.min(F.when(blocking, F.col("start"))).over(by.orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, 0))
        met = (F.coalesce(reach, F.lit(-1)) > F.col("start")) | (F.coalesce(following, F.lit(_LAST)) < F.col("end"))
        earlier = earlier | ((F.col("kind") == kind) & met)
    spans = spans.withColumn("_met", earlier).where("NOT _met")
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    span = F.struct("start", "kind", F.concat_ws(":", F.get(names, F.col("kind")), "start", "end").alias("text"), "score")
    listed = spans.groupBy("_row").agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{KINDS[k][0]}") for k in range(len(KINDS))],
        F.count(F.when(F.col("score") >= least, 1)).alias("n_sure"), F.array_sort(F.collect_list(span)).alias("_all"),
    )
    out = rows.select("doc_id", "_row").join(listed, "_row", "left")
    base = F.filter("_all", lambda s: s["kind"] < BASE)

    def joined(spans: Column, field: str) -> Column:
        return F.coalesce(F.array_join(F.transform(spans, lambda s: s[field].cast("string")), ","), F.lit(""))

    counts = [f"n_{k[0]}" for k in KINDS] + ["n_sure"]
    return out.select(
        "doc_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.sha2(joined(base, "text").cast("binary"), 256).alias("base_sha256"),
        joined(F.col("_all"), "text").alias("spans"), joined(F.col("_all"), "score").alias("scores"),
    )
