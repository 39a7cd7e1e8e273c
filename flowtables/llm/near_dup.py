"""MinHash near-dedup with odd sketches.

Every document becomes a set of hashed word shingles. Documents with equal sets form one class, and only its smallest
id goes on. A class has `SAMPLES` MinHash values: `BANDS` groups of `ROWS` of them name the buckets in which candidates
meet, and all of them are folded into an odd sketch, a bitmap of parities. The population count of the XOR of two sketches
estimates how many samples differ, most precisely at high similarity, and so drops most candidates before the sets
are compared in full.

A bucket's members are first held against its centre, the member that meets most others; copies of one text mostly link with it
and share a component from then on. What is left are pairs of different components: they are compared inside tasks, block
by block, and only links that join two components come out.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.llm.common import components, mix, shingles, slices, utf8, word_hashes
from flowtables.tables import cut

SAMPLES, BANDS, ROWS, SKETCH, BLOCK = 256, 32, 4, 1024, 512
WORDS = [f"s{j}" for j in range(SKETCH // 64)]
SEEDS = np.random.default_rng(7).integers(1, 1 << 32, (2, SAMPLES), dtype=np.uint32) | np.uint32(1)
SET_TYPE = "id long, n_shingles long, h1 long, h2 long, buckets array<long>, " + ", ".join(f"{w} long" for w in WORDS)


def minhashes(members: np.ndarray) -> np.ndarray:
    """The least value of each of SAMPLES hash orders over a set of 64-bit hashes."""
    h = (members >> np.uint64(32)).astype(np.uint32) ^ members.astype(np.uint32)
    out = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(h), 4096):
        part = (h[at : at + 4096] ^ SEEDS[0][:, None]) * SEEDS[1][:, None]
        part ^= part >> np.uint32(15)
        np.minimum(out, part.min(axis=1), out=out)
    return out


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """SKETCH parity bits of the pairs (order, least value), as 64-bit words."""
    bits = mix(samples.astype(np.uint64) + (np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32))) % np.uint64(SKETCH)
    parity = (np.bincount(bits.astype(np.int64), minlength=SKETCH) & 1).astype(np.uint8)
    return np.packbits(parity, bitorder="little").view(np.int64)


def sketch_limit(similarity: float) -> int:
    """The largest XOR population count that sketches of two sets with at least this similarity show.

    The mean for a pair at the limit and five standard deviations, of the number of samples that differ and of their
    folding into bits; a linked pair shows more less than once in a million.
    """
    differ = SAMPLES * (1 - similarity)
    stay = 1 - 2 / SKETCH
    mean = SKETCH / 2 * (1 - stay ** (2 * differ))
    slope = 2 * stay ** (2 * differ)
    folding = SKETCH / 4 * (1 - stay ** (4 * differ)) - SKETCH / 2 * (2 * differ / SKETCH) * stay ** (4 * differ)
    return math.ceil(mean + 5 * math.sqrt(slope**2 * SAMPLES * similarity * (1 - similarity) + max(folding, 1)))


def _sets(k: int):
    """Batches of (id, text) to the sorted distinct shingle hashes of each row."""

    def rows(batches):
        for part in slices(batches, "text"):
            raw, ends = utf8(part.column("text"))
            words, at = word_hashes(raw, ends)
            yield part.column("id"), [np.unique(shingles(words[a:b], k)) for a, b in zip(at[:-1], at[1:], strict=True)]

    return rows


def _signatures(k: int):
    rows = _sets(k)

    def run(batches):
        for ids, sets in rows(batches):
            n = np.array([len(s) for s in sets], np.int64)
            h1 = np.array([mix(s).sum(dtype=np.uint64) if len(s) else 0 for s in sets], np.uint64).view(np.int64)
            h2 = np.array([mix(s ^ np.uint64(0x5555555555555555)).sum(dtype=np.uint64) if len(s) else 0 for s in sets], np.uint64).view(np.int64)
            samples = np.stack([minhashes(s) for s in sets])
            bands = samples[:, : BANDS * ROWS].reshape(len(sets), BANDS, ROWS).astype(np.uint64)
            keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), bands.shape[:2])
            for j in range(ROWS):
                keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, j])
            sketch = np.stack([odd_sketch(x) for x in samples])
            ends = np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays([ids, pa.array(n), pa.array(h1), pa.array(h2), pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.view(np.int64).ravel())), *[pa.array(sketch[:, j]) for j in range(len(WORDS))]], ["id", "n_shingles", "h1", "h2", "buckets", *WORDS])

    return run


def _set_lists(k: int):
    rows = _sets(k)

    def run(batches):
        for ids, sets in rows(batches):
            ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
            flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["id", "members"])

    return run


def _alike(percent: int):
    """The condition on the sketches and set sizes of sides a and b that linked pairs meet."""
    apart = sum((F.bit_count(F.col(f"a_{w}").bitwiseXOR(F.col(f"b_{w}"))) for w in WORDS[1:]), F.bit_count(F.col(f"a_{WORDS[0]}").bitwiseXOR(F.col(f"b_{WORDS[0]}"))))
    sizes = 100 * F.least("a_n_shingles", "b_n_shingles") >= percent * F.greatest("a_n_shingles", "b_n_shingles")
    return sizes & (apart <= sketch_limit(percent / 100))


def _side(df: DataFrame, side: str, *others) -> DataFrame:
    return df.select(F.col("id").alias(side), *[F.col(w).alias(f"{side}_{w}") for w in ("n_shingles", *WORDS)], *others)


def _confirmed(near: DataFrame, texts: DataFrame, *, k: int, percent: int) -> DataFrame:
    """The (a, b) of `near` whose full sets have 100 * intersection >= percent * union; only their texts are read again and moved."""
    needed = near.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = cut(texts.join(needed, "id", "left_semi").mapInArrow(_set_lists(k), "id long, members array<long>"))
    left, right = (sets.select(F.col("id").alias(x), F.col("members").alias(f"m{x}")) for x in "ab")
    out = near.join(left, "a").join(right, "b").withColumn("both", F.size(F.array_intersect("ma", "mb")).cast("long"))
    return out.where(100 * F.col("both") >= percent * (F.size("ma").cast("long") + F.size("mb").cast("long") - F.col("both"))).select("a", "b")


def _candidates(rows: pd.DataFrame, percent: int):
    """For each row of the first block the rows of the second that it is still to be held against, as index pairs.

    Those of other components, of like size and sketch, with which it shares no bucket of an earlier band: there they meet already.
    """
    left, right = (np.flatnonzero(rows.side.isin(s).to_numpy()) for s in ((0, 2), (1, 2)))
    both = bool((rows.side == 2).any())
    size, group = rows.n_shingles.to_numpy(), rows.component.to_numpy()
    sketch = np.stack([rows[w].to_numpy().view(np.uint64) for w in WORDS], 1)
    earlier = np.stack(rows.buckets.to_numpy())[:, : int(rows.band.iloc[0])]
    limit = sketch_limit(percent / 100)
    for a in left:
        b = right[right > a] if both else right
        b = b[group[b] != group[a]]
        b = b[100 * np.minimum(size[b], size[a]) >= percent * np.maximum(size[b], size[a])]
        b = b[np.bitwise_count(sketch[b] ^ sketch[a]).sum(1) <= limit]
        b = b[~(earlier[b] == earlier[a]).any(1)]
        if len(b):
            yield int(a), b


def _involved(percent: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id", kind="stable").reset_index(drop=True)
        used = np.zeros(len(rows), bool)
        for a, b in _candidates(rows, percent):
            used[a] = True
            used[b] = True
        return rows.loc[used, ["bucket", "i", "j", "side", "band", "id"]]

    return run


def _joining(percent: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id", kind="stable").reset_index(drop=True)
        ids, group, sets = rows.id.to_numpy(), rows.component.to_numpy().copy(), [np.asarray(m, np.int64).view(np.uint64) for m in rows.members]  # in whose order they are sorted
        found = []
        for a, b in _candidates(rows, percent):
            b = b[group[b] != group[a]]  # components grow as links are found
            if not len(b):
                continue
            size = np.array([len(sets[k]) for k in b])
            flat = np.concatenate([sets[k] for k in b])
            own = sets[a]
            at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
            shared = np.add.reduceat((own[at] == flat).astype(np.int64), np.cumsum(size) - size)
            for k in b[100 * shared >= percent * (size + len(own) - shared)]:
                if group[k] != group[a]:
                    found.append((ids[a], ids[k]))
                    group[group == group[k]] = group[a]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return run


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of `docs`: id_col, n_shingles, component_id, kept.

    Links documents whose sets of `words`-word shingles have 100 * intersection >= percent * union; component_id is the
    smallest id reachable by links, kept tells whether it is the row's own. A-Z is lower-cased; words are runs of
    anything but white space; with fewer words the whole sequence is the one shingle.

    Null, empty and blank texts have the empty set and are linked with nothing. Rows with a null id get null
    component_id and kept false, and link nothing. Rows that repeat an id link as that id. An empty table gives an
    empty one; other columns are not looked at.

    The components are those of all linked pairs that share a bucket, as a link inside a component changes nothing. A pair at
    the limit shares none of the BANDS buckets less than once in a million.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = cut(base.mapInArrow(_signatures(words), SET_TYPE))
    filled = signed.where("id is not null and n_shingles > 0")
    first = cut(filled.groupBy("n_shingles", "h1", "h2").agg(F.min("id").alias("rep")))
    reps = cut(filled.join(first.select(F.col("rep").alias("id")), "id", "left_semi").dropDuplicates(["id", "n_shingles", "h1", "h2"]))
    texts = base.where("text is not null")

    members = reps.select("id", F.posexplode("buckets").alias("band", "bucket"))
    shared = cut(members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"))
    members = cut(members.join(shared, "bucket"))
    meets = cut(members.groupBy("id").agg(F.sum("n").alias("meets")))
    centres = cut(members.join(meets, "id").groupBy("bucket").agg(F.max_by("id", F.struct("meets", -F.col("id"))).alias("centre")))
    star = members.join(centres, "bucket").where("id != centre").select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct()
    sketches = reps.select("id", "n_shingles", *WORDS)
    near = cut(star.join(_side(sketches, "a"), "a").join(_side(sketches, "b"), "b").where(_alike(percent)).select("a", "b"))
    links = cut(_confirmed(near, texts, k=words, percent=percent))

    left = cut(members.join(components(links, "a", "b"), "id", "left").withColumn("component", F.coalesce("component", "id")))
    # a bucket of one component has nothing left, one of two members has been looked at
    mixed = cut(left.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n")).where("n > 2 and low < high").select("bucket"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = left.join(mixed, "bucket").withColumn("of", blocks).withColumn("own", F.pmod(F.xxhash64("id"), "of").cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("of") - 1)))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    placed = placed.select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), side.alias("side"), "band", "id", "component")
    known = reps.join(left.select("id", "component").distinct(), "id").select("id", "component", "n_shingles", "buckets", *WORDS)
    known = cut(known)
    key = ["bucket", "i", "j"]
    involved = cut(placed.drop("component").join(known, "id").groupBy(*key).applyInPandas(_involved(percent), "bucket long, i int, j int, side int, band int, id long"))
    needed = involved.select("id").distinct()
    sets = cut(texts.join(needed, "id", "left_semi").mapInArrow(_set_lists(words), "id long, members array<long>"))
    joining = involved.join(known.join(sets, "id"), "id").groupBy(*key).applyInPandas(_joining(percent), "a long, b long")
    comps = components(cut(links.union(joining)), "a", "b")

    classes = first.join(comps.withColumnRenamed("id", "rep"), "rep", "left").select("n_shingles", "h1", "h2", F.coalesce("component", "rep").alias("component"))
    joined = signed.select("id", "n_shingles", "h1", "h2").join(cut(classes), ["n_shingles", "h1", "h2"], "left")
    found = joined.select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"))
    return found.select(F.col("id").alias(id_col), "n_shingles", F.col("component").alias("component_id"), F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))
