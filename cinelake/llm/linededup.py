"""Line dedup by a deletion-neighbourhood join within an edit distance of one.

Lines (cut at \\n) are compared in normal form: lower case, white space runs as one space, trimmed. A line is dropped if an
earlier line, in the order of (doc_id, row, line), has the same normal form or one at an edit distance of one. Lines whose
normal form has fewer than ``min_chars`` characters are compared for exact copies only, from ``exact_chars`` on, and not at
all below; the registered query and the pipeline pass ALL_LINES, so that only lines without a visible character stay.

Exact copies meet by a 128-bit hash. For the rest, every distinct line emits, as hashed keys, all its variants with one
character deleted (with the place) and itself. Two lines at distance one share such a key: a substitution leaves the same
variant at the same place, an insertion makes one line the variant of the other. Within a key of the first kind
every line is at distance one from every other, and in one of the second every variant's line from the whole line, so
linking each line to its key's earliest line loses nothing and never emits pairs. Linked lines are verified by their edit
distance. The bound is one edit by design: a neighbourhood of two deletions has half the square of a line's length of keys, some
65,000 for a line of usual length, and keys that say less than a whole variant would leave pairs of a group to be listed.

Only lines that can have a partner emit variants: at distance one, the first or the second half of the shorter line (split
in the middle) stands at the same end of the other one. Both lines emit those halves as keys, by the length of the
shorter line; a line that shares no half has no partner.

Defined results: a null text stays null, an empty one empty, with no line dropped; rows that agree in id and text count
as one occurrence and lose the same lines; null ids come last; an empty table gives an empty table; columns named like
the added ones (``added``) are replaced. Texts are cut in their task, variants emitted in portions: memory grows with the
longest line.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake.llm.scratch import Scratch
from cinelake.llm.textcore import U64, mix64, powers

MIN_CHARS = 20
ALL_LINES = 1  # as exact_chars
MAX_BROADCAST_BYTES = 10 << 20  # of the wanted lines
WHOLE, PLACE, LOOSE = 0, 1, 2


def normal(line: str) -> str:
    return " ".join(line.lower().split())


def _half(kind: int, length: int, part: str) -> int:
    return xxhash.xxh3_64_intdigest(part.encode("utf-8", "surrogatepass"), seed=length * 2 + kind) - (1 << 63)


def half_keys(s: str) -> list[int]:
    """Keys of the halves as the shorter line (of this length), and as one a character longer than the other."""
    n = len(s)
    cut, less = n // 2, (n - 1) // 2
    return [
        _half(0, n, s[:cut]), _half(1, n, s[cut:]),
        _half(0, n - 1, s[:less]), _half(1, n - 1, s[n - (n - 1 - less) :]),
    ]


def variant_keys(s: str) -> np.ndarray:
    """Hashed keys: of the line itself as a whole, then of each one-character deletion as (variant, place) and as variant.

    The hash of a string is a polynomial in an odd base modulo 2**64 over scattered code points, so that the hash
    without one character follows from prefix sums.
    """
    codes = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(codes)
    pw, inv = powers("byte", n + 1)
    total = np.zeros(n + 1, U64)
    np.cumsum(mix64(codes) * pw[:n], out=total[1:])
    deleted = mix64(total[:-1] + (total[n] - total[1:]) * inv[1] + U64(n - 1))
    whole = mix64(total[n:] + U64(n))
    place = mix64(deleted ^ mix64(np.arange(n, dtype=U64) + U64(1 << 40)))
    return np.concatenate([whole, place, deleted])


def _lines(docs: DataFrame, min_chars: int, least: int) -> DataFrame:
    """docs(nul, id, key, text) -> one row per line to compare: nul, id, key, line, n, h1, h2, halves (none if exact only)."""
    out = T.StructType(
        [*docs.schema.fields[:3], *T._parse_datatype_string("line int, h1 bigint, h2 bigint, halves array<bigint>").fields]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at: list[int] = []
            cols: tuple[list, ...] = ([], [], [], [])

            def flush() -> pa.RecordBatch:
                take = pa.array(at, pa.int32())
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
                done = pa.RecordBatch.from_arrays(
                    [*(b.column(c).take(take) for c in range(3)), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                    names=[f.name for f in out],
                )
                at.clear()
                for c in cols:
                    c.clear()
                return done

            for i, text in enumerate(b.column(3)):
                text = text.as_py()
                if not text:
                    continue
                for k, line in enumerate(text.split("\n")):
                    if len(line) < least and len(line) * 3 < least:  # lower case makes at most three of one
                        continue
                    s = normal(line)
                    if len(s) < least:
                        continue
                    halves = half_keys(s) if len(s) >= min_chars else []
                    h = xxhash.xxh3_128_intdigest(s.encode("utf-8", "surrogatepass"))
                    at.append(i)
                    for c, v in zip(cols, (k, (h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63), halves)):
                        c.append(v)
                if len(at) >= 20_000:
                    yield flush()
            if at:
                yield flush()

    return docs.mapInArrow(run, out)


def _chosen_texts(docs: DataFrame, wanted: DataFrame, with_variants: bool) -> DataFrame:
    """The wanted lines (nul, id, key, line, h1, h2) with their normal text, and their variant keys if asked."""
    per = wanted.groupBy("id", "key").agg(F.collect_list(F.struct("line", "h1", "h2")).alias("want"))
    per = per.select(F.col("id").alias("id2"), F.col("key").alias("key2"), "want")
    texts = docs.select("nul", "id", "key", "text")
    size = F.sum(F.coalesce(F.octet_length(F.col("id").cast("string")), F.lit(0)) + 44)  # of each line: id, key, place, hash
    if (wanted.agg(size).first()[0] or 0) <= MAX_BROADCAST_BYTES:
        per = F.broadcast(per)
    joined = texts.join(per, (F.col("key") == F.col("key2")) & F.col("id").eqNullSafe(F.col("id2")))
    joined = joined.select("nul", "id", "key", "text", "want")
    out = T.StructType([*docs.select("nul", "id", "key").schema.fields, *T._parse_datatype_string(
        "line int, h1 bigint, h2 bigint, s string, variants array<bigint>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in out]
        for b in batches:
            for i in range(b.num_rows):
                lines = b.column(3)[i].as_py().split("\n")
                want = b.column(4)[i].as_py()
                for first in range(0, len(want), 500):
                    part = want[first : first + 500]
                    texts = [normal(lines[w["line"]]) for w in part]
                    keys = [variant_keys(s).view(np.int64) if with_variants else None for s in texts]
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(b.column(c).take(pa.array([i] * len(part), pa.int32())) for c in range(3)),
                            pa.array([w["line"] for w in part], pa.int32()), pa.array([w["h1"] for w in part], pa.int64()),
                            pa.array([w["h2"] for w in part], pa.int64()), pa.array(texts, pa.string()),
                            pa.array(keys, pa.list_(pa.int64())),
                        ],
                        names=names,
                    )

    return joined.mapInArrow(run, out)


def _with_shared(rows: DataFrame, key: str) -> DataFrame:
    """The rows whose key stands at two or more different lines. Both sides of the join read one exchange."""
    shared = rows.groupBy(key).agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a != b").select(key)
    return rows.join(shared, key, "left_semi")


def duplicate_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, max_edits: int = 1,
    exact_chars: int = MIN_CHARS,
) -> DataFrame:
    """(id, key, line, near) of every line to drop; key is row_key's. near: no exact earlier copy. max_edits: 0 or 1."""
    if max_edits not in (0, 1):
        raise ValueError("max_edits is 0 or 1")
    scratch = Scratch(docs.sparkSession, "lines")
    src = docs.select(F.col(id_col).isNull().alias("nul"), F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    lines = scratch.keep(_lines(src, min_chars, max(1, min(exact_chars, min_chars))), "lines")
    place = F.struct("nul", "id", "key", "line")
    distinct = lines.groupBy("h1", "h2").agg(
        F.min(place).alias("first"), F.max(place).alias("last"), F.any_value("halves").alias("halves")
    )
    distinct = scratch.keep(distinct, "distinct")
    before = distinct.where("first != last").select("h1", "h2", F.col("first").alias("earliest"))
    if max_edits:
        # Only hashes travel: a line is its h1 here, and (h1, h2) again once few are left.
        halves = distinct.select("h1", F.explode("halves").alias("half"))
        able = _with_shared(halves, "half").select("h1").distinct()
        able = distinct.join(able, "h1", "left_semi").select("first.*", "h1", "h2")
        texts = scratch.keep(_chosen_texts(src, scratch.keep(able, "able"), True), "variants")
        keys = texts.select("h1", F.length("s").alias("n"), F.posexplode("variants").alias("k", "key2"))
        kind = F.when(F.col("k") == 0, WHOLE).when(F.col("k") <= F.col("n"), PLACE).otherwise(LOOSE)
        keys = _with_shared(keys.select("h1", "key2", kind.alias("kind")), "key2")
        me = F.struct(place.alias("place"), "h1", "h2")
        keys = keys.join(texts.select("h1", me.alias("me")), "h1").select("key2", "kind", "me")
        keys = scratch.keep(keys, "keys")
        firsts = keys.groupBy("key2").agg(
            *(F.min(F.when(F.col("kind") == k, F.col("me"))).alias(name) for k, name in ((WHOLE, "w"), (PLACE, "p"), (LOOSE, "l")))
        )
        other = F.when(F.col("kind") == WHOLE, F.col("l")).when(F.col("kind") == PLACE, F.col("p")).otherwise(F.col("w"))
        links = keys.join(firsts, "key2").select("me", other.alias("other"))
        links = links.where(F.col("other").isNotNull() & (F.col("other.place") < F.col("me.place"))).distinct()
        s = texts.select("h1", "h2", "s")
        links = (
            links.select("me.h1", "me.h2", "other").join(s, ["h1", "h2"]).withColumnRenamed("s", "s1")
            .select(F.col("h1").alias("m1"), F.col("h2").alias("m2"), "s1", "other.*")
            .join(s, ["h1", "h2"]).where(F.levenshtein("s1", "s", 1) == 1)
        )
        near = links.groupBy(F.col("m1").alias("h1"), F.col("m2").alias("h2")).agg(F.min("place").alias("earliest"))
        before = before.unionByName(near).groupBy("h1", "h2").agg(F.min("earliest").alias("earliest"))
        before = scratch.keep(before, "before")
        scratch.release(lines, before)
    found = lines.join(before, ["h1", "h2"]).where(place > F.col("earliest"))
    return found.select("id", "key", "line").distinct()


def row_key(id_col: str, text_col: str):
    return F.xxhash64(F.col(id_col), F.col(text_col))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, max_edits: int = 1,
    exact_chars: int = MIN_CHARS, added: tuple[str, str] = ("n_lines", "n_dropped"),
) -> DataFrame:
    """The rows of docs with their repeated lines taken out of the text, and the counts of lines and dropped lines."""
    drops = duplicate_lines(docs, id_col, text_col, min_chars, max_edits, exact_chars)
    drops = drops.groupBy("id", "key").agg(F.sort_array(F.collect_list("line")).alias("__drop"))
    drops = drops.select(F.col("id").alias("__id"), F.col("key").alias("__key"), "__drop")
    keep = [c for c in docs.columns if c not in added]
    rows = docs.select(*keep, row_key(id_col, text_col).alias("__row"))
    out = rows.join(drops, (F.col("__row") == F.col("__key")) & F.col(id_col).eqNullSafe(F.col("__id")), "left")
    lines = F.split(F.col(text_col), "\n", -1)
    left = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(F.col("__drop"), i)), "\n")
    return out.select(
        *(F.when(F.col("__drop").isNull(), F.col(c)).otherwise(left).alias(c) if c == text_col else F.col(c) for c in keep),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias(added[0]),
        F.greatest(F.size("__drop"), F.lit(0)).cast("long").alias(added[1]),
    )
