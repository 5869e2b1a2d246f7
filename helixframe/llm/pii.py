"""Personal data by weak supervision, in DataFrame functions only.

Expressions propose spans of ten kinds; the first four are the base kinds, of which every span that meets its condition
stays. On each span four labelers vote yes (1), no (-1) or nothing (0): the strict form of the kind, gazetteers (given names,
places, mail providers, endings of public domains, calling codes, issuers, IBAN countries), words of the context around it,
and a checksum. Spans are counted by kind, votes and shape (length, separators, share of digits, neighbours; all in a few
steps, so there is a bounded number of combinations, whatever the corpus). Expectation-maximisation over the votes
estimates how often each labeler is right and so the probability of every combination of votes; a logistic classifier over
kind, votes and shape is fitted to those probabilities. It decides on the spans of the added kinds and tells its confidence in
every span, base ones included.

Offsets come from splitting a text at the same expression: lengths of the pieces between matches, in code points, summed in
blocks of about the square root of their number. The expressions take one run of characters once (possessive, anchored
at the run's start), so very long runs cost linear time and no recursion. Values that a lambda needs are bound as variables,
so they are computed once a row.

`longest` (254, the mail standard's bound): the strict form of a match longer than that is not looked at and votes no.

Defined cases: null and empty texts have no spans; repeated rows each give a row; an empty table gives an empty result;
very long texts are read whole; columns other than doc_id and text are ignored; without spans of added kinds the
classifier decides nothing.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import table, text_or_empty, written

KINDS = ("email", "ip", "card", "phone", "ssn", "iban", "local", "obfuscated", "person", "address")
BASE_KINDS = KINDS[:4]
DIGIT_RUN = r"[0-9](?:(?![ -](?![0-9]))[0-9 -]){12,}+"
#: Gazetteers: common given names, large cities, mail providers, endings of public domains.
GIVEN = (
    "Adam Ahmed Alexander Ali Alice Amanda Amir Amy Andrea Andrew Angela Anna Anthony Antonio Barbara Ben Brian Carlos Carmen Caroline Catherine Charles Charlotte Chen Chloe Christian "
    "Christine Claire Claudia Daniel David Diana Edward Elena Elizabeth Emily Emma Eric Eva Fatima Felix Fernando Florian Frank Franziska Gabriel George Hannah Hans Heinrich Helen Henry Ibrahim Ines "
    "Isabel Jack James Jan Jane Javier Jean Jennifer Jessica Johann John Jonas Jorge Jose Joseph Juan Julia Karen Karl Katharina Kevin Klaus Laura Lena Lisa Louis Lucas Lucia Luis Manuel Marco Maria "
    "Marie Mark Martin Mary Matthew Max Michael Miguel Mohammed Monika Natalie Nicolas Nina Olivia Omar Pablo Patricia Patrick Paul Paula Pedro Peter Petra Philipp Pierre Rachel Rafael Rebecca Richard "
    "Robert Rosa Ruth Samuel Sandra Sarah Sebastian Simon Sofia Sophie Stefan Stephen Susan Susanne Teresa Thomas Tim Tobias Ursula Victor Victoria William Wolfgang Yusuf"
).split()
PLACES = (
    "Amsterdam Athens Atlanta Barcelona Beijing Berlin Birmingham Boston Bristol Brussels Budapest Cairo Chicago Cologne Copenhagen Dallas Delhi Denver Detroit Dresden Dublin Edinburgh Frankfurt Geneva "
    "Glasgow Hamburg Helsinki Houston Istanbul Leeds Leipzig Lisbon Liverpool London Lyon Madrid Manchester Marseille Melbourne Miami Milan Montreal Moscow Mumbai Munich Naples Oslo Ottawa Paris "
    "Philadelphia Phoenix Portland Prague Rome Seattle Seville Shanghai Singapore Stockholm Stuttgart Sydney Tokyo Toronto Toulouse Valencia Vancouver Vienna Warsaw Washington Zurich"
).split()
PROVIDERS = "aol comcast fastmail free gmail gmx googlemail hotmail icloud laposte live mail mailbox msn orange outlook posteo proton protonmail t-online web yahoo yandex zoho".split()
ENDINGS = "at au be br ca ch cn com cz de dk edu es eu fi fr gov ie in info io it jp mil mx net nl no nz org pl pt ru se uk us".split()
TITLES = "Mr|Mrs|Ms|Miss|Dr|Prof|Sir|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora"
ROADS = "Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Boulevard|Blvd|Court|Ct|Square|Terrace"
#: The lists that a gazetteer table may give, and how many names each may have: they become parts of expressions.
LISTS = {"given": GIVEN, "places": PLACES, "providers": PROVIDERS, "endings": ENDINGS}
MOST_NAMES = 5000


def named(names: list[str]) -> str:
    """An expression of any of the names, longer ones first; one that nothing matches if there are none."""
    return "|".join(re.escape(n) for n in sorted(set(names), key=lambda n: (-len(n), n))) or "(?!)"


def person_pattern(given: list[str]) -> str:
    return rf"(?<![A-Za-z])(?=[A-Z])(?:(?:{TITLES})\.? (?:{named(given)}|[A-Z][a-z]++)|(?:{named(given)}))(?: [A-Z]\.)? [A-Z][a-z]++(?![A-Za-z])"


#: Equal in matches to the base expressions, for card but for runs too short to pass its condition.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9-](?:(?!\.(?![A-Za-z0-9-]))[A-Za-z0-9.-])*+",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": DIGIT_RUN,
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "ssn": r"(?<![0-9+-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])",
    "local": r"(?<![0-9+().-])(?<![0-9+)] )(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])",
    "obfuscated": r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]++ ?(?:\[at\]|\(at\)) ?[A-Za-z0-9-]++ ?(?:\[dot\]|\(dot\)) ?[A-Za-z]{2,}+",
    "person": person_pattern(GIVEN),
    "address": rf"(?<![0-9A-Za-z])[0-9]{{1,5}}+ (?:[A-Z][a-z]++ ){{1,3}}?(?:{ROADS})(?![A-Za-z])",
}
#: A cheap condition on the text before an expression is tried for offsets.
NEEDS = {"email": "@", "phone": "+", "ip": ".", "ssn": "-", "obfuscated": "at"}
#: The strict form of a kind (regex labeler).
STRICT = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@([A-Za-z0-9]([A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}$",
    "ip": r"^(0|[1-9][0-9]{0,2})(\.(0|[1-9][0-9]{0,2})){3}$",
    "card": r"^([0-9]{13,19}|[0-9]{4}([ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})$",
    "phone": r"^\+[1-9][0-9]{0,2}[ .-]?(\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}([ .-]?[0-9]{2,4}){1,4}$",
    "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
    "iban": r"^[A-Z]{2}[0-9]{2}[A-Z]{0,4}[0-9]{8,}[A-Z0-9]*$",
    "local": r"^(\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}([.-]))[2-9][0-9]{2}(?:\2|[ .-])[0-9]{4}$",
    "obfuscated": r"^[A-Za-z0-9][A-Za-z0-9._-]* ?[\[(]at[\])] ?[A-Za-z0-9-]+ ?[\[(]dot[\])] ?[A-Za-z]+$",
    "person": rf"^(?:(?:{TITLES})\.? )?[A-Z][a-z]+(?: [A-Z]\.)? [A-Z][a-z]+$",
    "address": rf"^[1-9][0-9]{{0,4}} (?:[A-Z][a-z]+ )+(?:{ROADS})$",
}
def gazetteer_patterns(lists: dict[str, list[str]]) -> dict[str, str]:
    """What the gazetteers say of a kind, with private networks, issuers, calling codes and IBAN countries."""
    return {
        "email": rf"(?i)@(?:{named(lists['providers'])})\.|\.(?:{named(lists['endings'])})$",
        "ip": r"^(?!0\.|255\.|127\.|22[4-9]\.|2[3-5][0-9]\.)",
        "card": r"^(4|5[1-5]|2[2-7]|3[47]|6011|65|35|30|36|38)",
        "phone": r"^\+(1|7|20|27|3[0-9]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])",
        "ssn": r"^(?!123-45-6789|078-05-1120|219-09-9999)",
        "iban": r"^(AD|AE|AL|AT|AZ|BA|BE|BG|BH|BR|CH|CR|CY|CZ|DE|DK|DO|EE|ES|FI|FO|FR|GB|GE|GI|GL|GR|GT|HR|HU|IE|IL|IS|IT|JO|KW|KZ|LB|LI|LT|LU|LV|MC|MD|ME|MK|MR|MT|MU|NL|NO|PK|PL|PS|PT|QA|RO|RS|SA|SE|SI|SK|SM|TN|TR|UA|VG|XK)",
        "local": r"^\(?(?!555|911|000)[2-9][0-8][0-9]",
        "obfuscated": rf"(?i)(?:{named(lists['endings'])})$",
        "person": rf"\b(?:{named(lists['given'])})\b",
        "address": rf"^[ ,;.]*(?:[0-9]{{4,5}} )?(?:{named(lists['places'])})\b",  # of the text after it
    }


#: Words of the context that speak for a kind, and words that speak against personal data.
CONTEXT = {
    "email": r"(?i)\b(e-?mail|mail|contact|write|correo|courriel|schreib)",
    "ip": r"(?i)\b(ip|address|host|server|login|from)\b",
    "card": r"(?i)\b(card|visa|mastercard|amex|credit|debit|payment|karte|carte|tarjeta)",
    "phone": r"(?i)\b(tel|phone|call|mobile|cell|fax|whatsapp|sms|telefon|t[eé]l[eé]fono?)",
    "ssn": r"(?i)\b(ssn|social security|tax id|tin)\b",
    "iban": r"(?i)\b(iban|account|bank|konto|compte|cuenta|transfer)",
    "local": r"(?i)\b(tel|phone|call|mobile|cell|fax|office|home)",
    "obfuscated": r"(?i)\b(e-?mail|mail|contact|write|reach)",
    "person": r"(?i)\b(name|contact|signed|regards|dear|born|patient|employee|customer|author|by|from|call)\b[^A-Za-z0-9]{0,4}$",
    "address": r"(?i)\b(address|live[sd]?|located|office|ship|deliver|home|house|at)\b",
}
AGAINST = r"(?i)\b(order|invoice|serial|isbn|issn|version|build|ticket|part|item|sku|ref|doi|id)\b[^a-z0-9]{0,4}$"
LONGEST = 254
VOTES = ("form", "gazetteer", "context", "checksum")
SHAPE = {"length": 4, "separators": 4, "digits": 3, "left": 4, "right": 4}  # and how many values each has
SPAN = "struct<kind:int,a:int,e:int," + ",".join(f"{c}:int" for c in (*VOTES, *SHAPE)) + ">"
FOUND = "array<struct<a:int,e:int,m:string,before:string,after:string>>"


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once a row."""
    return F.transform(F.array(value), body)[0]


def in_blocks(xs: Column) -> Column:
    """An array in blocks of about the square root of its length."""
    width = F.greatest(F.ceil(F.sqrt(F.size(xs))).cast("int"), F.lit(1))
    return bound(width, lambda w: F.transform(F.sequence(F.lit(0), ((F.greatest(F.size(xs), F.lit(1)) - 1) / w).cast("int")), lambda k: F.slice(xs, k * w + 1, w)))


def proposals(text: Column, pattern: str) -> Column:
    """array<struct<a, e, m, before, after>> of all matches: start and end in code points, the match, and 40 code points
    before and after it (up to the next match)."""
    parts = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("p"))
    none = F.array().cast(FOUND)

    def step(acc: Column, x: Column) -> Column:
        a = acc["at"] + F.length(x["p"])
        e = a + F.length(x["m"])
        one = F.struct(a.alias("a"), e.alias("e"), x["m"].alias("m"), F.right(x["p"], F.lit(40)).alias("before"), F.left(x["q"], F.lit(40)).alias("after"))
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    def placed(z: Column) -> Column:
        n = F.size(z["m"])
        rows = F.arrays_zip(z["m"].alias("m"), F.slice(z["p"], F.lit(1), n).alias("p"), F.slice(z["p"], F.lit(2), n).alias("q")).cast("array<struct<m:string,p:string,q:string>>")
        return bound(rows, lambda xs: F.transform(in_blocks(xs), lambda block: F.aggregate(block, F.struct(F.lit(0).alias("at"), none.alias("out")), step)))

    def joined(acc: Column, x: Column) -> Column:
        return F.struct((acc["at"] + x["at"]).alias("at"), F.concat(acc["out"], F.array(F.struct(acc["at"].alias("by"), x["out"].alias("xs")))).alias("out"))

    shifted = lambda y: F.transform(y["xs"], lambda x: F.struct((x["a"] + y["by"]).alias("a"), (x["e"] + y["by"]).alias("e"), x["m"].alias("m"), x["before"].alias("before"), x["after"].alias("after")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<struct<by:int,xs:{FOUND}>>").alias("out"))
    whole = lambda z: F.flatten(F.transform(F.aggregate(placed(z), start, joined)["out"], shifted))
    return bound(parts, whole)


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a digit string passes: from the right, every second digit doubled and its digits added."""
    each = F.transform(F.split(F.reverse(number), ""), lambda d, k: F.when(k % 2 == 0, F.try_to_number(d, F.lit("9")).cast("int")).otherwise(F.try_to_number(d, F.lit("9")).cast("int") * 2 - F.when(d > "4", 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda s, d: s + F.coalesce(d, F.lit(0))) % 10 == 0


def mod97(m: Column) -> Column:
    """Whether an IBAN's number, head moved to the end and letters as two digits, is 1 modulo 97."""
    moved = F.concat(F.substr(m, F.lit(5)), F.substring(m, 1, 4))
    value = lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.split(moved, ""), F.lit(0), lambda s, c: F.when(c == "", s).otherwise((s * F.when(value(c) < 10, 10).otherwise(100) + value(c)) % 97)) == 1


def holds(kind: str, m: Column) -> Column:
    """The condition that a match must meet."""
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
        return m.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.length(digits(m)).between(13, 19) & luhn(digits(m))
    if kind == "phone":
        return F.length(digits(m)).between(9, 15)
    return F.lit(True)


def neighbour(c: Column) -> Column:
    """What stands beside a span: 0 nothing, 1 white space, 2 a letter or digit, 3 a sign."""
    return F.when(c == "", 0).when(c.rlike(r"^\s$"), 1).when(c.rlike(r"^[\p{L}\p{N}]$"), 2).otherwise(3)


def voted(kind: str, x: Column, longest: int, listed_as: dict[str, str]) -> Column:
    """A span with the four votes on it and its shape."""
    m, before, after = x["m"], x["before"], x["after"]
    yes_no = lambda c: F.when(c, 1).otherwise(-1)
    form = F.when(F.length(m) > longest, -1).otherwise(yes_no(m.rlike(STRICT[kind])))
    listed = yes_no((after if kind == "address" else m).rlike(listed_as[kind]))
    context = F.when(before.rlike(CONTEXT[kind]), 1).when(before.rlike(AGAINST), -1).otherwise(0)
    checksum = yes_no(mod97(m)) if kind == "iban" else F.lit(1 if kind == "card" else 0)
    n = F.length(m)
    signs = F.length(F.regexp_replace(m, r"[\p{L}\p{N}]", ""))
    shape = (F.least(F.floor(n / 8), F.lit(3)), F.least(signs, F.lit(3)), F.least(F.floor(3 * F.length(digits(m)) / n), F.lit(2)), neighbour(F.right(before, F.lit(1))), neighbour(F.left(after, F.lit(1))))
    return F.struct(F.lit(KINDS.index(kind)), x["a"], x["e"], form, listed, context, checksum, *shape).cast(SPAN)


def keeps(kind: str) -> Callable[[Column], Column]:
    return lambda x: holds(kind, x["m"])


def votes_on(kind: str, longest: int, listed_as: dict[str, str]) -> Callable[[Column], Column]:
    return lambda x: voted(kind, x, longest, listed_as)


def lists_of(gazetteer: DataFrame | None) -> dict[str, list[str]]:
    """The lists of names: those of a table with the columns list (given, places, providers or endings) and name instead of the
    built-in ones of the same list. Lists that the table lacks are built in; null names and other lists are ignored."""
    if gazetteer is None:
        return LISTS
    rows = gazetteer.where(F.col("list").isin(*LISTS) & F.col("name").isNotNull() & (F.col("name") != "")).select("list", "name").distinct()
    got = rows.limit(MOST_NAMES * len(LISTS) + 1).collect()  # bounded
    out: dict[str, list[str]] = {}
    for r in got:
        out.setdefault(r["list"], []).append(r["name"])
    if any(len(x) > MOST_NAMES for x in out.values()):
        raise ValueError(f"a list of a gazetteer has more than {MOST_NAMES} names")
    return LISTS | out


def apart(added: Column, base: Column) -> Column:
    """The added spans that overlap no base span. Base spans in order are blocks with an extent, so a span is held against
    those of a block or two."""
    ordered = F.array_sort(F.transform(base, lambda y: F.struct(y["a"].alias("a"), y["e"].alias("e"))))
    extent = lambda ys: F.struct(ys[0]["a"].alias("lo"), F.array_max(F.transform(ys, lambda y: y["e"])).alias("hi"), ys.alias("ys"))
    blocks = bound(ordered, lambda ys: F.transform(in_blocks(ys), extent))
    meets = lambda x: lambda b: (b["lo"] < x["e"]) & (x["a"] < b["hi"]) & F.exists(b["ys"], lambda y: (y["a"] < x["e"]) & (x["a"] < y["e"]))
    return bound(blocks, lambda bs: F.filter(added, lambda x: ~F.exists(bs, meets(x))))


def candidates(docs: DataFrame, longest: int = LONGEST, gazetteer: DataFrame | None = None) -> DataFrame:
    """doc_id and the voted spans of every row, by kind, then start. Added kinds leave out what a base span covers."""
    text, lists = F.col("text"), lists_of(gazetteer)
    listed_as, patterns = gazetteer_patterns(lists), PATTERNS | {"person": person_pattern(lists["given"])}
    none = F.array().cast(f"array<{SPAN}>")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    for kind, pattern in patterns.items():
        there = text.rlike(pattern) if kind not in NEEDS else F.contains(text, F.lit(NEEDS[kind])) & text.rlike(pattern)
        found = F.transform(F.filter(proposals(text, pattern), keeps(kind)), votes_on(kind, longest, listed_as))
        rows = rows.withColumn(kind, F.when(there, found).otherwise(none))
    base, added = F.concat(*BASE_KINDS), F.concat(*KINDS[4:])
    free = F.when(F.size(added) == 0, none).when(F.size(base) == 0, added).otherwise(bound(F.struct(added.alias("added"), base.alias("base")), lambda z: apart(z["added"], z["base"])))
    return rows.select("doc_id", F.concat(base, free).alias("found"))


def estimate(counts: dict[tuple[int, ...], int], rounds: int = 100) -> tuple[dict[tuple[int, ...], float], list[list[list[float]]]]:
    """Expectation-maximisation over counted votes (kind, vote, vote, ...): the probability that spans of each
    combination are personal data, and per labeler and class the probabilities of no, nothing, yes. A labeler is right with
    one probability, whatever the truth, where it votes; what it says nothing of tells nothing. It is taken to be right four
    times of five at the start, with the weight of ten votes, so classes cannot change places."""
    width = len(next(iter(counts))) - 1
    p = {v: 1 / (1 + math.exp(-1.2 * sum(v[1:]) - 0.3)) for v in counts}
    tables: list[list[list[float]]] = []
    for _ in range(rounds):
        prior: dict[int, list[float]] = {}
        right, votes = [8.0] * width, [10.0] * width
        for v, n in counts.items():
            share = prior.setdefault(v[0], [2.0, 2.0])
            share[0] += (1 - p[v]) * n
            share[1] += p[v] * n
            for k in range(width):
                if v[k + 1]:
                    right[k] += n * (p[v] if v[k + 1] > 0 else 1 - p[v])
                    votes[k] += n
        tables = [[[r / m, 1.0, 1 - r / m], [1 - r / m, 1.0, r / m]] for r, m in zip(right, votes, strict=True)]
        new = {}
        for v in counts:
            odds = math.log(prior[v[0]][1] / prior[v[0]][0]) + sum(math.log(max(tables[k][1][v[k + 1] + 1], 1e-9) / max(tables[k][0][v[k + 1] + 1], 1e-9)) for k in range(width))
            new[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        moved = max(abs(new[v] - p[v]) for v in counts)
        p = new
        if moved < 1e-6:
            break
    return p, tables


def classifier(counts: dict[tuple[int, ...], int], p: dict[tuple[int, ...], float], steps: int = 400, rate: float = 0.5, l2: float = 0.01) -> list[float]:
    """Weights of a logistic model fitted to the probabilities `p` of combinations (kind, votes...) or (kind, votes...,
    shape...), weighed by the logarithm of their count: 1, the votes, then a weight for each kind and for each value of
    each shape."""
    keys = list(counts)
    x = np.array([features(v) for v in keys])
    y, weight = np.array([p[v[: 1 + len(VOTES)]] for v in keys]), np.log1p([counts[v] for v in keys])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        miss = (1 / (1 + np.exp(-(x @ w))) - y) * weight / weight.sum()
        w -= rate * (miss @ x + l2 * w)
    return w.tolist()


def features(v: tuple[int, ...]) -> list[float]:
    """The classifier's input for a combination; without a shape the shape's values are all 0."""
    out = [1.0, *map(float, v[1 : 1 + len(VOTES)]), *(float(k == v[0]) for k in range(len(KINDS)))]
    shape = v[1 + len(VOTES) :] or [None] * len(SHAPE)
    for own, size in zip(shape, SHAPE.values(), strict=True):
        out += [float(own == k) for k in range(size)]
    return out


def score_of(weights: list[float]) -> Callable[[Column], Column]:
    """The classifier's log-odds of a span."""

    def score(x: Column) -> Column:
        at = 1 + len(VOTES)
        of = lambda field, n: F.element_at(F.array(*map(F.lit, weights[at : at + n])), x[field] + 1)
        total = sum((x[v] * F.lit(w) for v, w in zip(VOTES, weights[1:at], strict=True)), F.lit(weights[0])) + of("kind", len(KINDS))
        at += len(KINDS)
        for field, n in SHAPE.items():
            total += of(field, n)
            at += n
        return total

    return score


def find(docs: DataFrame, longest: int = LONGEST, gazetteer: DataFrame | None = None) -> DataFrame:
    """One row per document: counts and digest of the base kinds, all spans, and the classifier's confidence in each of
    them in percent. `gazetteer`: a table of names, as lists_of reads it."""
    found = written(candidates(docs, longest, gazetteer), "pii-candidates")
    # at most kinds * 3 ** votes * shapes rows
    combos = found.select(F.explode("found").alias("x")).groupBy("x.kind", *(f"x.{v}" for v in (*VOTES, *SHAPE))).agg(F.count("*").alias("n")).collect()
    counts = {tuple(r)[:-1]: r["n"] for r in combos}
    of_votes: dict[tuple[int, ...], int] = {}
    for v, n in counts.items():
        of_votes[v[: 1 + len(VOTES)]] = of_votes.get(v[: 1 + len(VOTES)], 0) + n
    score = score_of(classifier(counts, estimate(of_votes)[0]) if counts else [0.0] * len(features((0,) * (1 + len(VOTES)))))
    kept = F.filter("found", lambda x: (x["kind"] < len(BASE_KINDS)) | (score(x) >= 0))
    name = lambda x: F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1)
    told = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", name(x), x["a"].cast("string"), x["e"].cast("string"))), ",")
    base = F.filter("found", lambda x: x["kind"] < len(BASE_KINDS))
    amount = lambda k: F.size(F.filter("found", lambda x: x["kind"] == k)).cast("long")
    percent = lambda x: F.round(100 / (1 + F.exp(-score(x)))).cast("int").cast("string")
    confidence = F.array_join(F.transform(kept, percent), ",")
    return found.select("doc_id", *(amount(k).alias(f"n_{kind}") for k, kind in enumerate(BASE_KINDS)), F.sha2(told(base), 256).alias("base_sha256"), told(kept).alias("spans"), confidence.alias("confidence"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
