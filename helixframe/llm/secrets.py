"""Secret scans: keyword automaton, anchored expressions at its hits, checksum validation.

Every whole text is seen as one byte per code point (characters beyond latin-1 become '?', which no expression
accepts), so byte offsets are code points. An Aho-Corasick automaton finds the keywords; an expression is tried only
where a keyword begins. Hexadecimal runs have no keyword: a byte translation that blanks everything else shows at
once whether a text holds a run that is long enough.

Base kinds: assign, access, hex. Kinds that the method adds: github tokens (ghp_, gho_, ghu_, ghs_, ghr_) and npm tokens of
36 characters, of which the last six must be the base-62 CRC-32 of the rest (tokens of other lengths and fine-grained ones
have no known checksum and are not sought); jwt, of which the head must decode to a JSON object; pem private keys with
labels of up to 40 characters.

Defined cases: null and empty texts have no spans; repeated rows each give a row; an empty table gives an empty
result; a text is read in a time linear in its length, however often a keyword comes in it; of matches of a kind that
overlap the first counts; columns other than doc_id and text are ignored by `scan`.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import slices, table

KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "pem")
BASE_KINDS = KINDS[:3]
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
GITHUB = re.compile(rb"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
NPM = re.compile(rb"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
JWT = re.compile(rb"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+")
#: Where an expression fails for want of what must follow a run of these, it fails at every keyword in that run.
RUN = {"jwt": re.compile(rb"[A-Za-z0-9_-]+")}
PEM = re.compile(rb"-----BEGIN ([A-Z ]*)PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END \1PRIVATE KEY-----")
HEX_RUN = re.compile(rb"h{24,}")
HEX_TABLE = bytes(104 if chr(c) in "0123456789abcdef" else 32 for c in range(256))
HEX_LEAST = b"h" * 24
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def checksum_holds(token: bytes) -> bool:
    """The last six characters are the CRC-32 of the body in base 62."""
    body, tail = token.split(b"_", 1)[1][:-6], token[-6:].decode()
    n, out = zlib.crc32(body), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = BASE62[d] + out
    return out == tail


def jwt_holds(token: bytes) -> bool:
    head = token.split(b".")[0]
    try:
        return isinstance(json.loads(base64.urlsafe_b64decode(head + b"=" * (-len(head) % 4))), dict)
    except (ValueError, RecursionError):  # no base 64, no text, no JSON, or JSON nested without end
        return False


#: keyword in lower case, whether its case counts, kind, expression, and what a match must satisfy.
RULES = [
    *((w, False, "assign", ASSIGN, lambda m: len(m[2]) >= 6) for w in ASSIGN_WORDS),
    ("akia", True, "access", ACCESS, lambda m: len(m[0]) >= 20),
    *((f"gh{c}_", True, "github", GITHUB, lambda m: checksum_holds(m[0])) for c in "pousr"),
    ("npm_", True, "npm", NPM, lambda m: checksum_holds(m[0])),
    ("eyj", True, "jwt", JWT, lambda m: jwt_holds(m[0])),
    ("-----begin ", True, "pem", PEM, lambda m: True),
]


def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for k, (word, *_) in enumerate(RULES):
        a.add_word(word, (k, len(word)))
    a.make_automaton()
    return a


def spans_of(text: str | None, keywords: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, place of the kind in KINDS, end) of every span, in order. Of one kind spans are leftmost and do not
    overlap; a match that fails its condition is consumed and dropped."""
    if not text:
        return []
    b = text.encode("latin-1", "replace")
    out: list[tuple[int, int, int]] = []
    over: dict[str, int] = {}
    low = b.lower().decode("latin-1")
    starts = sorted((end - n + 1, k) for end, (k, n) in keywords.iter(low))
    for start, k in starts:
        _, _, kind, pattern, holds = RULES[k]
        if start < over.get(kind, 0):
            continue
        if m := pattern.match(b, start):
            over[kind] = m.end()
            if holds(m):
                out.append((start, KINDS.index(kind), m.end()))
        elif kind in RUN:
            over[kind] = RUN[kind].match(b, start).end()
    runs = b.translate(HEX_TABLE)
    if HEX_LEAST in runs:
        out += [(m.start(), 2, m.end()) for m in HEX_RUN.finditer(runs)]
    return sorted(out)


def told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{e}" for a, k, e in spans)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, and all spans of every row's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keywords = automaton()
        for b in slices(batches):
            found = [spans_of(t, keywords) for t in b.column(1).to_pylist()]
            counts = [pa.array([sum(x[1] == k for x in f) for f in found], pa.int64()) for k in range(3)]
            digest = pa.array([hashlib.sha256(told([x for x in f if x[1] < 3]).encode()).hexdigest() for f in found], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), *counts, digest, pa.array([told(f) for f in found], pa.string())], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redacted(text: str | None, keywords: ahocorasick.Automaton, mark: str = "[SECRET]") -> str | None:
    """The text with every span, overlapping ones taken together, replaced by `mark`."""
    spans = spans_of(text, keywords)
    if not spans:
        return text
    out, at = [], 0
    a, e = spans[0][0], spans[0][2]
    for start, _, end in [*spans[1:], (len(text) + 1, 0, 0)]:
        if start < e:
            e = max(e, end)
            continue
        out += [text[at:a], mark]
        at, a, e = e, start, end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """All columns of `docs` in their order, secrets in the text replaced; n_chars, where present, follows the new text."""
    names = docs.columns
    at, count = names.index(text), names.index("n_chars") if "n_chars" in names else None
    typed = docs.withColumn("n_chars", F.col("n_chars").cast("long")) if count is not None else docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keywords = automaton()
        for b in slices(batches):
            cols = list(b.columns)
            old = cols[at].to_pylist()
            new = [redacted(t, keywords, mark) for t in old]
            cols[at] = pa.array(new, pa.string())
            if count is not None:
                cols[count] = pa.array([n if a == x else len(x) for a, x, n in zip(old, new, cols[count].to_pylist(), strict=True)], pa.int64())
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return typed.mapInArrow(run, typed.schema)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def found_sql(kind: str, expression: str, condition: str) -> str:
    """Spans of an expression that needs no look-ahead: lengths of the pieces between its matches give their places."""
    place = f"list_sum(list_transform(pieces[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0)"
    return f"""SELECT doc_id, n, '{kind}' AS kind, CAST(a AS BIGINT) AS a, CAST(a + length(m) AS BIGINT) AS e FROM (SELECT doc_id, n, hits[i] AS m, {place} AS a
  FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM (SELECT doc_id, n, regexp_extract_all(t, '{expression}') AS hits, string_split_regex(t, '{expression}') AS pieces FROM d WHERE regexp_matches(t, '{expression}')))) WHERE {condition}"""


def token_sql(kind: str, prefix: str) -> str:
    """Tokens of 36 characters after a prefix of four, and no more; one that begins inside the one before is part of it."""
    place = "list_sum(list_transform(pieces[1:i], lambda x: length(x))) + 4 * (i - 1)"
    crc = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(substr(m, 5, 30)), '..'), lambda x: ('0x' || x)::BIGINT)), lambda c, x: xor(c >> 8, crcs[(xor(c, x) & 255) + 1])), 4294967295::BIGINT)"
    digits = " || ".join(f"substr('{BASE62}', crc // {62**k} % 62 + 1, 1)" for k in reversed(range(6)))
    return f"""SELECT doc_id, n, '{kind}' AS kind, CAST(a AS BIGINT) AS a, CAST(a + 40 AS BIGINT) AS e FROM (SELECT *, {crc} AS crc FROM (SELECT *, lag(a) OVER (PARTITION BY n ORDER BY a) AS before
  FROM (SELECT doc_id, n, a, substr(t, a + 1, 40) AS m, substr(t, a + 41, 1) AS next FROM (SELECT doc_id, n, t, CAST({place} AS BIGINT) AS a FROM (SELECT *, unnest(range(1, len(pieces))) AS i
  FROM (SELECT doc_id, n, t, string_split_regex(t, '{prefix}') AS pieces FROM d WHERE regexp_matches(t, '{prefix}')))) WHERE regexp_full_match(substr(t, a + 5, 36), '[A-Za-z0-9]{{36}}') AND NOT regexp_full_match(substr(t, a + 41, 1), '[A-Za-z0-9]')) WHERE true) , tab
  WHERE before IS NULL OR a - before >= 40) WHERE substr(m, 35, 6) = {digits}"""


_ASSIGN = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
_PEM = "-----BEGIN ([A-Z ]*)PRIVATE KEY-----[A-Za-z0-9+/=\\x20\\x09-\\x0D]+-----END ([A-Z ]*)PRIVATE KEY-----"
_HEAD = "translate(split_part(m, '.', 1), '-_', '+/')"
_JSON = f"try(decode(from_base64({_HEAD} || repeat('=', CAST((4 - length({_HEAD}) % 4) % 4 AS BIGINT)))))"
_KIND = "list_position([" + ", ".join(f"'{k}'" for k in KINDS) + "], kind)"
#: Every kind by its expression, tokens with the CRC-32 of their body in base 62, heads of tokens as JSON.
OP5_SQL = f"""
WITH RECURSIVE bits AS (SELECT i, i::BIGINT AS c, 0 AS k FROM range(256) r(i) UNION ALL
  SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::BIGINT) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS crcs FROM bits WHERE k = 8),
d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS n FROM documents),
s AS ({found_sql('assign', _ASSIGN, f"length(regexp_extract(m, '{_ASSIGN}', 2)) >= 6")}
UNION ALL {found_sql('access', 'AKIA[A-Z0-9]+', 'length(m) >= 20')}
UNION ALL {found_sql('hex', '[0-9a-f]+', 'length(m) >= 24')}
UNION ALL {found_sql('jwt', 'eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+[.][A-Za-z0-9_-]+', f"coalesce(CASE WHEN length({_HEAD}) % 4 <> 1 AND json_valid({_JSON}) THEN json_type({_JSON}) = 'OBJECT' END, false)")}
UNION ALL {found_sql('pem', _PEM, f"regexp_extract(m, '{_PEM}', 1) = regexp_extract(m, '{_PEM}', 2)")}
UNION ALL {token_sql('github', 'gh[pousr]_')}
UNION ALL {token_sql('npm', 'npm_')}),
g AS (SELECT n, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(kind || ':' || a || ':' || e, ',' ORDER BY a, {_KIND}) FILTER (kind IN ('assign', 'access', 'hex')) AS base, string_agg(kind || ':' || a || ':' || e, ',' ORDER BY a, {_KIND}) AS spans FROM s GROUP BY n)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (n)
"""
