"""Source divergence audit against brute force."""

from __future__ import annotations

import os
import random
import re
from collections import Counter, defaultdict

import duckdb
import pyarrow as pa
import pytest

from helixframe.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string"


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows: list[tuple], best: int = 200) -> list[tuple]:
    """rows: (doc_id, text, lang, source)."""
    docs = [(lang or "", source or "", TERM.findall(lower(text or ""))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for d in own for t in set(d[2]))
        kept = sorted(t for t, n in df.items() if n >= 3)
        counts: dict[str, Counter] = defaultdict(Counter)
        for _, source, terms in own:
            counts[source].update(t for t in terms if df[t] >= 3)
        total = sum(counts.values(), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in counts.items()}, share(total)
        far = lambda x, y: (x - y) ** 2 // y
        for s in counts:
            pairs = [(sum(far(p[s][t], p[o][t]) for t in kept), o) for o in counts if o != s]
            terms = [(far(p[s][t], q[t]), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, best)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(ranked[:most])]
    return sorted(out)


def made(n: int, seed: int = 3, words: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    pool = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(words)] + ["Älter", "ÉTÉ", "日本", "the", "THE"]
    rows: list[tuple] = [(k, " ".join(rng.choice(pool[: rng.randrange(3, len(pool))]) + rng.choice(["", ",", "7", "-x"]) for _ in range(rng.randrange(40))), rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "s2", "s2", "s3", "", None, "ü", "z"])) for k in range(n)]
    return rows + [(None, "the the", "en", "s1")] * 5 + [(7, None, "en", "alone"), (8, "", "xx", "none"), (9, "1 2 3 !", "xx", "other"), (9, "only two", "yy", "a"), (9, "only two", "yy", "b")]


def result(df) -> list[tuple]:  # noqa: ANN001
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in df.collect())


def test_against_brute_force(spark):
    rows = made(300)
    assert result(divergence.divergence(spark.createDataFrame(rows, SCHEMA).repartition(5))) == brute(rows)


@pytest.mark.parametrize("groups", [1, 4])
def test_many_passes_give_the_same(spark, monkeypatch, groups):
    rows = made(80, seed=groups)
    monkeypatch.setattr(divergence, "GROUPS", groups * 4)
    assert result(divergence.divergence(spark.createDataFrame(rows, SCHEMA), best=5)) == brute(rows, best=5)


def test_a_term_in_every_document_and_copies(spark):
    rows = [(1, "same words again and again", "en", "hot")] * 400 + [(k, f"same word{chr(97 + k % 5)}", "en", f"s{k % 3}") for k in range(60)]
    assert result(divergence.divergence(spark.createDataFrame(rows, SCHEMA).repartition(7))) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert divergence.divergence(empty).collect() == []
    rows = made(40)
    plain = spark.createDataFrame(rows, SCHEMA)
    more = plain.selectExpr("*", "'x' as term", "1 as count", "2 as rank", "'y' as item", "3 as value", "4 as block", "5 as n", "6 as v", "7 as document")
    assert result(divergence.divergence(more)) == brute(rows)


def test_long_texts_in_pieces(monkeypatch):
    rng = random.Random(1)
    text = "".join(rng.choice(["ab", "é", " ", "-", "Z", "日本語", "."]) for _ in range(9000)) + "q" * 5000
    want = [t.encode() for t in TERM.findall(lower(text))]
    for piece in (1, 7, 100, 5000, 1 << 20):
        monkeypatch.setattr(divergence, "PIECE", piece)
        assert [w for part in divergence.words_of(text.encode()) for w in part] == want
    assert list(divergence.words_of(b"")) == []


@pytest.mark.parametrize("chunk", [1, 50, 200_000])
def test_chunks_and_batches_do_not_matter(monkeypatch, chunk):
    """A run that goes over many batches and chunks is one run."""
    monkeypatch.setattr(divergence, "CHUNK", chunk)
    rows = [(lang or "", source or "", doc, text or "") for doc, text, lang, source in made(120)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[k].encode() if k != 2 else r[k] for r in rows], pa.int64() if k == 2 else pa.binary()) for k in range(4)], names=["lang", "source", "document", "text"])
    t = pa.Table.from_batches(divergence.combined(iter([batch]))).sort_by([("lang", "ascending"), ("term", "ascending"), ("source", "ascending"), ("document", "ascending")])
    for size in (1, 3, 1000):
        got = [r for b in divergence.scanned(iter(t.to_batches(max_chunksize=size))) for r in b.to_pylist()]
        found = {(r["lang"], r["term"], s): c for r in got for s, c in zip(r["sources"], r["counts"], strict=True)}
        df: Counter = Counter()
        counts: Counter = Counter()
        for lang, source, _, text in rows:
            terms = TERM.findall(lower(text))
            df.update((lang, x) for x in set(terms))
            counts.update((lang, x, source) for x in terms)
        assert found == {tuple(x.encode() for x in key): n for key, n in counts.items() if df[key[:2]] >= 3}
        assert len({(r["lang"], r["term"]) for r in got}) == len(got)


def test_shares_are_exact():
    rng = random.Random(2)
    for _ in range(300):
        total = rng.choice([rng.randrange(1, 50), rng.randrange(1, 9 * 10**15)])
        count = rng.randrange(total)
        assert int(divergence.share(count, total)) == 1 + 10**9 * (count + 1) // total


def test_sql(spark):
    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("no driver tables here")
    c = duckdb.connect()
    c.sql(f"create view documents as select * from '{d}/documents.parquet'")
    got = divergence.op12_source_divergence(spark, d)
    want = c.sql(divergence.OP12_SQL)
    assert got.columns == want.columns
    assert result(got) == sorted(want.fetchall())
