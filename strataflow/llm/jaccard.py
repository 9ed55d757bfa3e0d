"""N-gram Jaccard join by a token-group matrix: documents whose sets of word shingles overlap enough are linked.

1. Equal sets are one set.  Min-hash bands bring similar sets together; an exact comparison with a few leaders of each band connects
   near copies by a few comparisons per member, however many they are.
2. Similar sets, those of one band, are partitioned into groups of about ``GROUP``; a set like no other is a group of its own.  The matrix holds the
   union of its members' tokens for every group.  Of a set of ``a`` tokens whose links share ``t`` at least, the first ``a - t + l`` in one
   order of all tokens do: two linked sets have ``l`` of these in common.  The order puts tokens that many documents share last: those common in
   one batch, and all that ``CROWD`` groups or more share in the matrix, where they are counted.  Sets whose rows hold such a token go on
   without it and with a smaller ``l``; those whose rows would hold too little begin anew.  So a token meets few groups, however many have it.
3. A query's overlap with a group is bounded by the tokens the two have in common in the matrix, which is joined with itself by token and counted
   for each pair of groups: a group bounds all its members as queries at once.  Pairs below their ``l``, and groups whose members are connected
   already, are never opened.
4. Where a group is opened, its members meet the queries of the other group in one task, by parities: each token flips one of 2,048 bits, so the
   bits that differ are at most as many as the tokens that do.  Only pairs near enough leave the task; they are compared token by token.  At first
   only the nearest pair between two connected sets leaves; then groups are opened again for what is not connected yet, without that limit.

Every link between sets that are not connected yet is found.  Tokens are 64-bit hashes of shingles, sets are known by 128 bits.  Neither the order of the
tokens nor the grouping has any influence on the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.common import body, components, table, text_hash
from strataflow.session import settle

SHINGLE, PERCENT = 5, 80
BANDS, ROWS = 4, 2  # min-hash bands for the groups; hashes in each
LEADERS = 3  # members of a band that all its members are compared with
GROUP = 64  # similar sets in a group, about
PARITY = 2048  # bits that hold the parities of a set
HEAVY = 4  # sets of one batch that share a token for it to be counted as common
CROWD = 8  # groups that share a token of the matrix for it to be put last
THRONG = 64  # groups that share it for the texts around it to be counted whole
HOT = 1 << 20  # common tokens the order knows of, 16 MB: beyond them the rarer ones are ordered like any other
LAST = 1 << 40  # weight that puts a token behind all that are common in batches only
PROBE = 500_000  # rows of keys that are sent to the texts; with more, texts are shuffled to the keys
MARKS = "doc_id long, row long, n long, sig binary, keys array<long>, bits binary, token long, times long"
SEEDS = np.random.default_rng(13).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        out = self[word] = xxhash.xxh64_intdigest(word)
        return out


_HASHES = _WordHashes()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def tokens(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """The set of the text's word shingles, A-Z lower-cased, as sorted hashes; fewer words are one shingle, no words none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    length = min(shingle, len(words))
    marks = np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))
    total = np.full(len(words) - length + 1, np.uint64(length))
    for k in range(length):
        total = total * BASE + marks[k:len(words) - length + 1 + k]
    return np.unique(_mixed(total))


def least_shared(n: int, percent: int = PERCENT) -> int:
    """Tokens that a set of ``n`` shares at least with any set it is linked to."""
    return -(-percent * n // 100)


def _spare(n: int, percent: int) -> int:
    """How many tokens two linked sets must share in the matrix; each one makes the rows of a set longer by one."""
    return min(1 + n // 40, least_shared(n, percent))


def _keys(found: np.ndarray) -> np.ndarray:
    least = _mixed(found[None, :] ^ SEEDS[:, None]).min(axis=1).reshape(BANDS, ROWS)
    out = np.arange(BANDS, dtype=np.uint64)
    for column in least.T:
        out = _mixed(out * BASE + column)
    return out.view(np.int64)


def _bits(found: np.ndarray) -> np.ndarray:
    odd = np.bincount((found >> np.uint64(20)).astype(np.int64) % PARITY, minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def _near(n: np.ndarray, bits: np.ndarray, other_n: np.ndarray, other_bits: np.ndarray, percent: int) -> np.ndarray:
    """Which sets can be linked, by their sizes and by the parities that differ; the arrays are broadcast against each other."""
    differ = np.bitwise_count(bits ^ other_bits).sum(axis=-1, dtype=np.int64)
    # Linked sets share at least percent (a + b) / (100 + percent) tokens; all others of a and b differ.
    return (100 * n >= percent * other_n) & (100 * other_n >= percent * n) & (differ * (100 + percent) <= (n + other_n) * (100 - percent))


def _long(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def marks(rows: DataFrame, shingle: int) -> DataFrame:
    """One row per document with its set's size, name, min-hash keys and parities, and rows (token, times) of tokens common in a batch."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [tokens(text, shingle) for text in batch.column("body").to_pylist()]
            names = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            different = {name: s for name, s in zip(names, sets)}
            token, times = np.unique(np.concatenate(list(different.values()) or [np.zeros(0, np.uint64)]), return_counts=True)
            common, blank = times >= HEAVY, pa.nulls
            full = [len(s) > 0 for s in sets]
            yield _batch(
                batch.column("doc_id"), batch.column("row"), pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.binary()),
                pa.array([_keys(s) if f else [] for s, f in zip(sets, full)], pa.list_(pa.int64())),
                pa.array([_bits(s).tobytes() if f else b"" for s, f in zip(sets, full)], pa.binary()),
                blank(len(sets), pa.int64()), blank(len(sets), pa.int64()))
            if common.any():
                size = int(common.sum())
                yield _batch(
                    *[blank(size, pa.int64()) for _ in range(3)], blank(size, pa.binary()), blank(size, pa.list_(pa.int64())),
                    blank(size, pa.binary()), pa.array(_long(token[common])), pa.array(times[common].astype(np.int64)))

    def _batch(*columns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(list(columns), [part.split()[0] for part in MARKS.split(", ")])

    return rows.mapInArrow(of, MARKS)


def common_tokens(found: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted tokens known to be common and how often each was counted: at most ``HOT``, the most frequent ones."""
    return _most_frequent(found.where("token IS NOT NULL").groupBy("token").agg(F.sum("times").alias("times")), "common-tokens")


def crowded_tokens(matrix: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted tokens that ``CROWD`` groups or more share, and in how many they are: at most ``HOT``, the most frequent ones.  One row per group."""
    return _most_frequent(matrix.groupBy("token").agg(F.count(F.lit(1)).alias("times")).where(F.col("times") >= CROWD), "crowded-tokens")


def _most_frequent(counted: DataFrame, label: str) -> tuple[np.ndarray, np.ndarray]:
    counted = settle(counted, label)
    by_size = counted.groupBy(F.floor(F.log2("times")).alias("power")).count().orderBy(F.desc("power")).collect()
    held, least = 0, 0
    for row in by_size:  # one row per power of two
        if held + row["count"] > HOT:
            least = 1 << (row.power + 1)
            break
        held += row["count"]
    kept = counted.where(F.col("times") >= least).toPandas()
    token, times = kept["token"].to_numpy(np.int64).view(np.uint64), kept["times"].to_numpy(np.int64)
    order = np.argsort(token)
    return token[order], times[order]


def merged(order: tuple[np.ndarray, np.ndarray], over: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The tokens and weights of ``order`` and ``over``; a token of both has the weight that it has in ``over``."""
    other = ~np.isin(order[0], over[0], assume_unique=True)
    token, times = (np.concatenate([x[other], y]) for x, y in zip(order, over))
    order = np.argsort(token)
    return token[order], times[order]


def _first(found: np.ndarray, hot: tuple[np.ndarray, np.ndarray], percent: int) -> np.ndarray:
    """The tokens of a set that stand in the matrix: the first ones in the order of all tokens."""
    token, times = hot
    n = len(found)
    wanted = n - least_shared(n, percent) + _spare(n, percent)
    if len(token):
        at = np.minimum(np.searchsorted(token, found), len(token) - 1)
        weight = np.where(token[at] == found, times[at], 0)
        if weight.any():
            found = found[np.argsort(weight, kind="stable")]  # equal weights stay in the order of the hashes
    return found[:wanted]


def matrix_rows(rows: DataFrame, hot: Broadcast, shingle: int, percent: int) -> DataFrame:
    """(doc_id, row, spare, first) of every document with words; ``first`` is the whole set with ``percent`` 0."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [tokens(text, shingle) for text in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("row"), pa.array([_spare(len(s), percent) for s in sets], pa.int64()),
                pa.array([_long(_first(s, hot.value, percent)) for s in sets], pa.list_(pa.int64()))], ["doc_id", "row", "spare", "first"])

    return rows.mapInArrow(of, "doc_id long, row long, spare long, first array<long>").where("size(first) > 0")


def first_tokens(rows: DataFrame, order: Broadcast, of_set: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The matrix rows of the documents in ``of_set``, with its columns."""
    keys = of_set.withColumnsRenamed({"doc_id": "_id", "row": "_row"})
    return matrix_rows(rows, order, shingle, percent).join(keys, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row"))).drop("_id", "_row")


def uncrowded(firsts: DataFrame, crowded: Broadcast) -> DataFrame:
    """Matrix rows without their crowded tokens.

    What is left is where the row begins once these tokens are put last, with as many fewer to spare; with none to spare it is too short.
    """
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = np.sort(_long(crowded.value[0]))
        for batch in batches:
            first = batch.column("first")
            flat = first.flatten().to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(token, flat), len(token) - 1)
            kept = token[at] != flat
            ends = np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], np.cumsum(first.value_lengths().to_numpy())])]
            fewer = first.value_lengths().to_numpy() - np.diff(ends)
            out = {name: batch.column(name) for name in batch.schema.names}
            out["spare"] = pa.array(batch.column("spare").to_numpy() - fewer)
            out["first"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat[kept]))
            yield pa.RecordBatch.from_arrays(list(out.values()), list(out))

    return firsts.mapInArrow(of, firsts.schema)


def _named(sets: DataFrame, name: str) -> DataFrame:
    return sets.select(F.col("sig").alias(name), F.col("n").alias(f"{name}_n"), F.col("bits").alias(f"{name}_bits"))


def short_rows(begun: DataFrame) -> DataFrame:
    """The documents whose matrix rows are too short without their crowded tokens; these are read from the texts again."""
    return settle(begun.where("spare < 1").drop("spare", "first").distinct(), "short-rows")


def _texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows with the ids and texts of ``wanted``, a small table or a large one, with its other columns."""
    keys = wanted.withColumnsRenamed({"doc_id": "_id", "row": "_row"})
    small = wanted.count() <= PROBE
    return rows.join(F.broadcast(keys) if small else keys, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row"))).drop("_id", "_row")


def linked(pairs: DataFrame, sets: DataFrame, rows: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose sets overlap enough, compared token by token; only texts of sets in a pair are read into tokens."""
    wanted = settle(pairs.select(F.col("u").alias("sig")).union(pairs.select(F.col("v").alias("sig"))).distinct().join(
        sets.select("sig", "doc_id", "row"), "sig"), "opened")
    held = _texts(rows, wanted)

    @F.pandas_udf("binary")
    def packed(bodies: pd.Series) -> pd.Series:
        return pd.Series([tokens(text, shingle).tobytes() for text in bodies])

    @F.pandas_udf("long")
    def shared(left: pd.Series, right: pd.Series) -> pd.Series:
        out = [len(np.intersect1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), assume_unique=True)) for a, b in zip(left, right)]
        return pd.Series(out, dtype="int64")

    # Rows that repeat id and text hold the same set.
    members = settle(held.select("sig", packed("body").alias("tokens")).dropDuplicates(["sig"]), "opened-sets")
    left, right = (members.select(F.col("sig").alias(name), F.col("tokens").alias(f"{name}_tokens")) for name in "uv")
    both = pairs.select("u", "v").join(left, "u").join(right, "v").withColumn("shared", shared("u_tokens", "v_tokens"))
    union = ((F.octet_length("u_tokens") + F.octet_length("v_tokens")) / 8).cast("long") - F.col("shared")
    return both.where(100 * F.col("shared") >= percent * union).select("u", "v")


def _met(rows: DataFrame, summary: DataFrame, key: str) -> DataFrame:
    """A join with a summary by the key it was grouped by, and a hash of that: both sides are shuffled anew, so that a hot key can be split."""
    spread = F.xxhash64(key).alias("_spread")
    return rows.select("*", spread).join(summary.select("*", spread), ["_spread", key]).drop("_spread")


def star_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """(u, v): every set with the leaders of each of its bands, where they can be linked."""
    @F.pandas_udf("boolean")
    def near(n: pd.Series, bits: pd.Series, other_n: pd.Series, other_bits: pd.Series) -> pd.Series:
        left, right = (np.frombuffer(b"".join(column), np.uint64).reshape(len(column), -1) for column in (bits, other_bits))
        return pd.Series(_near(n.to_numpy(), left, other_n.to_numpy(), right, percent))

    bands = sets.select("sig", F.explode("keys").alias("band"))
    leaders = bands.groupBy("band").agg(
        F.min("sig").alias("least"), F.max("sig").alias("last"), *[F.min_by("sig", F.xxhash64("sig", F.lit(n))).alias(f"leader{n}") for n in range(1, LEADERS)])
    leaders = leaders.where("least < last").select("band", F.array("least", *[f"leader{n}" for n in range(1, LEADERS)]).alias("leaders"))
    pairs = _met(bands, leaders, "band").select(F.col("sig").alias("u"), F.explode("leaders").alias("v")).where("u <> v")
    pairs = pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    both = pairs.join(_named(sets, "u"), "u").join(_named(sets, "v"), "v")
    return both.where(near("u_n", "u_bits", "v_n", "v_bits")).select("u", "v")


def similar_groups(sets: DataFrame, connected: DataFrame) -> DataFrame:
    """The sets with ``grp``, the group of similar sets they are in, and ``comp``, what they are connected with so far."""
    banded = sets.select("sig", F.explode("keys").alias("band"))
    sizes = banded.groupBy("band").agg(F.count(F.lit(1)).alias("size"))
    # Of its bands a set goes by the one that most sets share, so that similar sets seldom fall apart into groups of one.
    fullest = _met(banded, sizes, "band").groupBy("sig").agg(F.max(F.struct("size", "band")).alias("top")).select("sig", "top.size", "top.band")
    part = F.pmod(F.xxhash64("sig"), F.ceil(F.col("size") / GROUP))
    grouped = sets.join(fullest, "sig").withColumn("grp", F.when(F.col("size") == 1, F.xxhash64("sig")).otherwise(F.xxhash64("band", part)))
    return grouped.join(connected, "sig").select("sig", "doc_id", "row", "times", "n", "bits", "grp", F.xxhash64("root").alias("comp"))


def group_tokens(firsts: DataFrame, label: str | None = None) -> DataFrame:
    """(token, grp, comp, spare): the matrix, each token once for every group; a set on its own is its own union."""
    token = F.explode("first").alias("token")
    several = F.col("several") | F.col("again")
    union = firsts.where(several).select("grp", "comp", "spare", token).groupBy("grp", "comp", "token").agg(F.min("spare").alias("spare"))
    union = settle(union, label) if label else union
    return firsts.where(~several).select(token, "grp", "comp", "spare").unionByName(union)


def group_pairs(matrix: DataFrame) -> DataFrame:
    """(a, b): groups whose token unions overlap by as much as links between their members need, unless all members are connected already."""
    left, right = (matrix.select("token", *[F.col(c).alias(f"{side}_{c}") for c in ("grp", "spare", "comp")]) for side in "ab")
    apart = ~F.coalesce(F.col("a_comp") == F.col("b_comp"), F.lit(False))
    met = left.join(right, (left.token == right.token) & (F.col("a_grp") < F.col("b_grp")) & apart)
    counted = met.groupBy(F.col("a_grp").alias("a"), F.col("b_grp").alias("b")).agg(
        F.count(F.lit(1)).alias("overlap"), F.min(F.least("a_spare", "b_spare")).alias("needed"))
    return counted.where("overlap >= needed").select("a", "b")


def opened_pairs(pairs: DataFrame, grouped: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """(u, v): members of opened groups that can be linked and are not connected yet; the others never leave the task.

    With ``nearest``, of all pairs between two sets of connected members only the nearest one of an opened pair of groups.
    """
    members = grouped.groupBy("grp").agg(F.collect_list(F.struct("sig", "n", "comp", "bits")).alias("held"))  # about GROUP entries
    left, right = (members.select(F.col("grp").alias(side), *[F.col(f"held.{c}").alias(f"{side}_{c}") for c in ("sig", "n", "comp", "bits")]) for side in "ab")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, u, v = batch.to_pydict(), [], []
            for at in range(batch.num_rows):
                sig, n, comp, bits = ([rows[f"{side}_{c}"][at] for side in "ab"] for c in ("sig", "n", "comp", "bits"))
                sizes, comps = [np.array(x) for x in n], [np.array(x) for x in comp]
                marks = [np.frombuffer(b"".join(x), np.uint64).reshape(len(x), -1) for x in bits]
                near = _near(sizes[0][:, None], marks[0][:, None], sizes[1], marks[1], percent) & (comps[0][:, None] != comps[1])
                one, other = np.nonzero(near)
                if nearest and len(one) > 1:
                    order = np.bitwise_count(marks[0][one] ^ marks[1][other]).sum(axis=1).argsort(kind="stable")
                    ends = np.stack([comps[0][one], comps[1][other]], axis=1)[order]
                    kept = order[np.unique(ends, axis=0, return_index=True)[1]]
                    one, other = one[kept], other[kept]
                u += [sig[0][n] for n in one]
                v += [sig[1][n] for n in other]
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary())], ["u", "v"])

    found = pairs.join(left, "a").join(right, "b").mapInArrow(of, "u binary, v binary")
    # A group that is opened for its own members finds a pair from either side.
    return found.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _grouped(sets: DataFrame, links: DataFrame, label: str) -> DataFrame:
    """(sig, root) of every set; sets without links are their own root."""
    roots = components(links, label)
    return sets.select("sig").join(roots, F.col("sig") == F.col("node"), "left").select("sig", F.coalesce("root", "sig").alias("root"))


def jaccard_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT,
) -> DataFrame:
    """(doc_id, row, n_shingles, component_id) of every row, ``row`` a hash of the text.

    Null, empty and blank texts have no shingles and are linked with nothing: their component is their own doc_id.  component_id is the smallest
    doc_id reachable over links; rows without a doc_id take part, and a component of such rows alone has a null component_id.  Rows that repeat a
    doc_id are linked by their texts only.  An empty table gives an empty result.
    """
    if not 0 < percent <= 100 or shingle < 1:
        raise ValueError("percent from 1 to 100 and shingles of one word at least")
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_hash(F.col(text)).alias("row"), body(F.col(text)).alias("body"))
    found = settle(marks(rows, shingle), "shingle-sets")
    own = found.where("n IS NOT NULL")
    # Copies of a set are counted before they meet; the set stands for itself by its smallest id, missing ids last.
    copies = own.where("n > 0").groupBy("sig", "doc_id", "row").agg(
        F.count(F.lit(1)).alias("times"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("bits").alias("bits"))
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row", "times", "n", "keys", "bits")
    sets = settle(copies.groupBy("sig").agg(F.min(place).alias("first")).select("sig", "first.*"), "different-sets")

    near = settle(linked(settle(star_pairs(sets, percent), "band-pairs"), sets, rows, shingle, percent), "band-links")
    groups = settle(_grouped(sets, near, "bands"), "groups")
    grouped = settle(similar_groups(sets, groups), "grouped-sets")
    sizes = grouped.groupBy("grp").agg(
        F.count(F.lit(1)).alias("members"), F.when(F.min("comp") == F.max("comp"), F.min("comp")).alias("comp"))

    common = common_tokens(found)
    hot = spark.sparkContext.broadcast(common)
    of_set = grouped.drop("comp").join(sizes, "grp").select(
        "doc_id", "row", "grp", "comp", (F.col("members") > 1).alias("several"), (F.col("times") > 1).alias("again"))
    firsts = settle(first_tokens(rows, hot, of_set, shingle, percent), "first-tokens")
    crowded = crowded_tokens(group_tokens(firsts))
    if len(crowded[0]):
        throng = crowded[1] >= THRONG
        if throng.any():
            # A row with hardly any other tokens has more of them in its text, beyond its first ones: there all that are not known yet are counted.
            short = short_rows(uncrowded(firsts, spark.sparkContext.broadcast((crowded[0][throng], crowded[1][throng]))))
            whole = first_tokens(_texts(rows, short.select("doc_id", "row")), hot, short, shingle, 0)
            whole = uncrowded(whole, spark.sparkContext.broadcast(merged(common, crowded)))
            crowded = merged(crowded_tokens(whole.select("grp", F.explode("first").alias("token")).distinct()), crowded)
        begun = settle(uncrowded(firsts, spark.sparkContext.broadcast(crowded)), "uncrowded-tokens")
        short = short_rows(begun)
        order = spark.sparkContext.broadcast(merged(common, (crowded[0], crowded[1] + LAST)))
        again = settle(first_tokens(_texts(rows, short.select("doc_id", "row")), order, short, shingle, percent), "first-tokens-again")
        firsts = begun.where("spare > 0").unionByName(again)
    matrix = group_tokens(firsts, "group-unions")
    # A group whose members are not all connected is opened for its own members too.
    mixed = sizes.where("comp IS NULL").select(F.col("grp").alias("a"), F.col("grp").alias("b"))
    opened = settle(group_pairs(matrix).unionByName(mixed), "group-pairs")
    nearest = settle(linked(settle(opened_pairs(opened, grouped, percent, True), "nearest-pairs"), sets, rows, shingle, percent), "nearest-links")
    near = settle(near.union(nearest), "near-links")
    roots = settle(_grouped(sets, near, "nearest"), "set-roots")
    so_far = roots.select("sig", F.xxhash64("root").alias("comp"))
    regrouped = settle(grouped.drop("comp").join(so_far, "sig"), "regrouped-sets")
    across = settle(linked(settle(opened_pairs(opened, regrouped, percent, False), "opened-pairs"), sets, rows, shingle, percent), "opened-links")
    if not across.isEmpty():
        roots = settle(_grouped(sets, near.union(across), "linked"), "set-roots")

    least = roots.join(sets.select("sig", "doc_id"), "sig").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = _met(roots, least, "root").select("sig", "component_id")
    linked_rows = own.where("n > 0").join(named, "sig").select("doc_id", "row", F.col("n").alias("n_shingles"), "component_id")
    empty = own.where("n = 0").select("doc_id", "row", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked_rows.unionByName(empty)


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and component of every document's shingle set."""
    return jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")
