"""Secret scan with corpus-wide ownership frequency.

A first pass finds candidates in whole texts and takes a hash of each secret value. Over the whole corpus these hashes are
counted by distinct repositories and owners: a value that several owners hold is an example that people copy (documentation
keys, test fixtures), one that a single owner holds is that owner's own and live-looking if its characters are random
enough. Values that few bits tell apart are placeholders, whoever holds them.

Counting goes in steps, each combined before its shuffle: distinct (value, owner, repository), then owners with their
repositories, then values; a value that a third of all documents hold is one row for each repository by then. Verdicts go
back by a join in which the copied values, the only ones that can be hot, are met by salted rows.

Kinds. assign, access and hex are those of the contract, leftmost and not overlapping for each kind. Further ones: github,
slack, google, stripe (keys with the issuers' fixed beginnings), jwt (three base64url parts), pem (a private key's header up
to its end line, or to the text's end) and url (user and password before a host). A candidate's value is the part that is secret: the assigned
value, the password of a URL, else the whole.

Defined results: null text counts as empty; a null owner or repository is one of its own; repeated rows are scanned each and
count once as a repository; a null doc_id is passed on; of spans with equal starts the kind listed first comes first; texts
are taken whole, whatever their length; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewise.llm.common import stash, tidy_batches, tune

BASE = ("assign", "access", "hex")
#: kind: (pattern, group of the value, least length of the value). Fixed values of the contract come first.
RULES: dict[str, tuple[re.Pattern, int, int]] = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}"), 0, 24),
    "github": (re.compile(r"(?<![A-Za-z0-9_])(?:gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{40,})"), 0, 0),
    "slack": (re.compile(r"(?<![A-Za-z0-9-])xox[abeoprs]-[A-Za-z0-9-]{10,}"), 0, 0),
    "google": (re.compile(r"(?<![A-Za-z0-9_-])AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])"), 0, 0),
    "stripe": (re.compile(r"(?<![A-Za-z0-9_])[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"), 0, 0),
    "jwt": (re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"), 0, 0),
    "pem": (re.compile(r"-----BEGIN (?:[A-Z]{1,20} ){0,3}PRIVATE KEY-----(?:[^-]|-(?!----))*(?:-----END (?:[A-Z]{1,20} ){0,3}PRIVATE KEY-----)?"), 0, 0),
    "url": (re.compile(r"(?<![A-Za-z0-9+.-])[a-z][a-z0-9+.-]{1,15}://[^\s:/@?#]{1,100}:([^\s:/@?#]{3,100})@"), 1, 0),
}
#: What a text must hold, in small letters, for the rule to be tried; every match holds it.
HINTS: dict[str, tuple[str, ...]] = {"assign": ("passw", "secret", "token", "api"), "access": ("akia",), "github": ("gh", "github_pat_"), "slack": ("xox",), "google": ("aiza",), "stripe": ("k_live_", "k_test_"), "jwt": ("eyj",), "pem": ("private key",), "url": ("://",)}
ORDER = {kind: i for i, kind in enumerate(RULES)}

COPIED_OWNERS = 3
LIVE_BITS = 2.5
LIVE_CHARS = 8
SALTS = 32


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind's number, end, value) of all candidates, in order."""
    out, small = [], text.lower()
    for kind, (pattern, group, least) in RULES.items():
        if kind in HINTS and not any(h in small for h in HINTS[kind]):
            continue
        out += [(m.start(), ORDER[kind], m.end(), m[group]) for m in pattern.finditer(text) if len(m[group]) >= least]
    return sorted(out)


def random_looking(value: str) -> bool:
    """Long enough, of letters and digits or of several cases, and not of few repeated characters."""
    n = len(value)
    if n < LIVE_CHARS:
        return False
    bits = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    kinds = sum(any(t(c) for c in value) for t in (str.isdigit, str.islower, str.isupper))
    return bits >= LIVE_BITS and kinds >= 2


def _digest(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=16).digest()[:8], "big", signed=True)


FOUND = "row long, doc_id long, owner string, repository string, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, found array<struct<start:int,kind:int,end:int,h1:long,h2:long,random:boolean>>"
_FOUND = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("random", pa.bool_())]))


def scanned(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """One row for each document with its candidates; row tells rows of equal doc_id apart."""
    kinds = list(RULES)

    def run(batches):
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            out: dict[str, list] = {k: [] for k in ("row", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "found")}
            for text in b["text"].to_pylist():
                seen = candidates(text or "")
                named = [(k, f"{kinds[k]}:{a}:{z}") for a, k, z, _ in seen]
                n = Counter(k for k, _ in named)
                out["row"].append(row)
                row += 1
                for k, kind in enumerate(BASE):
                    out[f"n_{kind}"].append(n[k])
                out["base_sha256"].append(hashlib.sha256(",".join(s for k, s in named if k < len(BASE)).encode()).hexdigest())
                out["spans"].append(",".join(s for _, s in named))
                hashed = []
                for a, k, z, value in seen:
                    h = hashlib.blake2b(value.encode(), digest_size=16).digest()
                    hashed.append({"start": a, "kind": k, "end": z, "h1": int.from_bytes(h[:8], "big", signed=True), "h2": int.from_bytes(h[8:], "big", signed=True), "random": random_looking(value)})
                out["found"].append(hashed)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), _FOUND)
            made = {k: pa.array(v, t) for (k, v), t in zip(out.items(), types, strict=True)}
            columns = {"row": made["row"], "doc_id": b["doc_id"], "owner": b["owner"], "repository": b["repository"]} | {k: made[k] for k in list(made)[1:]}
            yield pa.record_batch(list(columns.values()), names=list(columns))

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), owner.cast("string").alias("owner"), repository.cast("string").alias("repository"), "text")
    return source.mapInArrow(tidy_batches(run), FOUND)


def ownership(found: DataFrame) -> DataFrame:
    """h1, h2, n_owners, n_repositories of every candidate value of the corpus."""
    held = found.select("owner", "repository", F.explode(F.array_distinct(F.transform("found", lambda x: F.struct(x.h1.alias("h1"), x.h2.alias("h2"))))).alias("v"))
    held = held.groupBy(F.col("v.h1").alias("h1"), F.col("v.h2").alias("h2"), "owner", "repository").agg(F.lit(1).alias("one"))
    owners = held.groupBy("h1", "h2", "owner").agg(F.count("*").alias("n"))
    return owners.groupBy("h1", "h2").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repositories"))


def scan(docs: DataFrame, owner: Column | None = None, repository: Column | None = None) -> DataFrame:
    """docs(doc_id, text, source, lang) -> doc_id, n_assign, n_access, n_hex, base_sha256, spans, and by ownership n_copied,
    n_live, n_weak (candidates of the three verdicts), max_owners (of the document's most widely held value) and live_spans.
    owner is the source unless another column is given, repository the source's part in one language."""
    spark = tune(docs.sparkSession)
    owner = F.col("source") if owner is None else owner
    repository = F.concat_ws("/", F.coalesce("source", F.lit("\0")), F.coalesce("lang", F.lit("\0"))) if repository is None else repository
    found = stash(scanned(docs, owner, repository), "candidates")
    counted = stash(ownership(found).filter("n_owners > 1"), "owned")
    salted = counted.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spans = found.select("row", F.explode("found").alias("c")).select("row", "c.*").withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    met = spans.join(salted, ["h1", "h2", "salt"], "left").withColumn("n_owners", F.coalesce("n_owners", F.lit(1)))
    copied, live = F.col("n_owners") >= COPIED_OWNERS, F.col("random") & (F.col("n_owners") < COPIED_OWNERS)
    names = F.array(*map(F.lit, RULES))
    parts = F.sort_array(F.collect_list(F.when(live, F.struct("start", "kind", "end"))))  # of one document
    judged = met.groupBy("row").agg(
        F.count_if(copied).alias("n_copied"),
        F.count_if(live).alias("n_live"),
        F.count_if(~copied & ~live).alias("n_weak"),
        F.max("n_owners").alias("max_owners"),
        F.array_join(F.transform(parts, lambda x: F.concat_ws(":", F.element_at(names, x.kind + 1), x.start, x.end)), ",").alias("live_spans"),
    )
    out = found.select("row", "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans").join(judged, "row", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_copied", "n_live", "n_weak", "max_owners")]
    return out.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", *zero, F.coalesce("live_spans", F.lit("")).alias("live_spans"))
