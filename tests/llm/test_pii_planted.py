"""Added kinds of personal data on planted spans and decoys, with and without the classifier; gazetteers from a table."""

from __future__ import annotations

import random

import pytest

from helixframe.llm import pii
from tests.llm.test_operators import docs_of

PLAIN = "the of and to a in is was that with for on as by it at from this which be or an are not".split()


def iban(rng: random.Random) -> str:
    body = "".join(str(rng.randrange(10)) for _ in range(18))
    number = int("".join(str(int(c, 36)) for c in f"{body}DE00"))
    return f"DE{98 - number % 97:02d}{body}"


def phone(rng: random.Random) -> str:
    return f"{rng.choice('23678')}{rng.choice('02345678')}{rng.randrange(10)}-{rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}"


def planted(n: int, seed: int) -> tuple[list[tuple[int, str]], dict[int, set[str]], dict[int, set[str]]]:
    """Documents, true spans and decoys: numbers of the same form in another context, or that no one could have."""
    rng = random.Random(seed)
    texts, true, false = [], {}, {}
    for k in range(n):
        words = [rng.choice(PLAIN) for _ in range(30)]
        at = rng.randrange(5, 25)
        kind = rng.choice(["ssn", "iban", "local", "person", "address", "obfuscated"])
        decoy = rng.random() < 0.4
        span = {
            "ssn": lambda: f"{rng.randrange(900, 999) if decoy else rng.randrange(100, 665)}-{rng.randrange(10, 99)}-{rng.randrange(1000, 9999)}", "iban": lambda: "XX" + iban(rng)[2:] if decoy else iban(rng), "local": lambda: "111-" + phone(rng)[4:] if decoy else phone(rng),
            "person": lambda: f"{rng.choice(pii.GIVEN)} {rng.choice(['Kowalsky', 'Bernhardt', 'Okafor'])}", "address": lambda: f"{rng.randrange(10, 999)} {rng.choice(['Maple', 'Birch'])} Street", "obfuscated": lambda: f"joe{k} [at] mail [dot] {'qqqqq' if decoy else 'com'}",
        }[kind]()
        lead = {"ssn": ("order", "ssn"), "iban": ("serial", "iban"), "local": ("part", "call"), "person": ("", "name"), "address": ("", "lives at"), "obfuscated": ("version", "write")}[kind][not decoy]
        if kind in ("person", "address") and decoy:
            span, lead = rng.choice(["Big Yellow", "Old Stone"]), ""
        if kind == "address":
            span += "" if decoy else ""
        text = " ".join([*words[:at], *([lead] if lead else []), span, *([", Paris"] if kind == "address" and not decoy else []), *words[at:]])
        start = text.index(span)
        (false if decoy else true).setdefault(k, set()).add(f"{kind}:{start}:{start + len(span)}")
        texts.append((k, text))
    return texts, true, false


def test_what_the_classifier_is_worth(spark):
    texts, true, false = planted(900, 4)
    docs = docs_of(spark, texts)
    added = lambda spans: {x for x in spans.split(",") if x and x.split(":")[0] not in pii.BASE_KINDS}
    kept = {r.doc_id: added(r.spans) for r in pii.find(docs).collect()}
    every = {r.doc_id: {f"{pii.KINDS[x.kind]}:{x.a}:{x.e}" for x in r.found if x.kind >= len(pii.BASE_KINDS)} for r in pii.candidates(docs).collect()}

    def judged(found: dict[int, set[str]]) -> tuple[float, float]:
        right = sum(len(found[k] & true.get(k, set())) for k in found)
        return right / max(1, sum(map(len, found.values()))), right / sum(map(len, true.values()))

    (with_p, with_r), (without_p, without_r) = judged(kept), judged(every)
    print(f"with the classifier: precision {with_p:.3f}, recall {with_r:.3f}; without: {without_p:.3f}, {without_r:.3f}")
    assert with_r >= 0.9 and with_p >= 0.95 and with_p > without_p + 0.05
    assert sum(len(every[k] & false.get(k, set())) for k in every) > 2 * sum(len(kept[k] & false.get(k, set())) for k in kept)


def test_gazetteer_table(spark):
    docs = docs_of(spark, [(1, "signed by Xqarl Bernhardt and Adam Bernhardt, Madam. (Xqarl B"), (2, "")])
    table = spark.createDataFrame([("given", "Xqarl"), ("given", None), ("other", "x"), ("given", "")], "list string, name string")
    of = lambda g: pii.find(docs, gazetteer=g).where("doc_id = 1").first().spans
    assert of(table) == "person:10:25" and of(None) == "person:30:44"
    with pytest.raises(ValueError, match="more than"):
        pii.lists_of(spark.range(pii.MOST_NAMES + 1).selectExpr("'given' as list", "cast(id as string) as name"))


def test_names_of_any_length(spark):
    name = "B" + "e" * 200
    row = pii.find(docs_of(spark, [(1, f"name Adam {name} lives at 12 {name} Street, Paris")])).first()
    assert f"person:5:{10 + len(name)}" in row.spans and "address:" in row.spans
