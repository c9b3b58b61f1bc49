"""Approximate nearest neighbours by balanced posting lists.

Centroids are fitted on a bounded sample: halves cut at the median along the
widest direction, then a few k-means steps in which a list pays for being
longer than the others, so the lists stay balanced. Every vector goes to the
list of its nearest centroid and, near a border, also to further lists almost
as near (``REPLICAS`` at most). A query takes the lists whose centroid is not
much farther than the nearest (distance ratio); the ratio is the least that
reaches the target recall within the sample. Lists that follow each other (they
are near, as halves of halves) make groups of bounded size, and a query's vector
goes once to each group that holds some of its lists, not to each list. Groups
of long lists are cut into blocks and their queries into chunks of bounded size,
so a long list or one that many queries take is searched by many tasks.

The search goes in rounds (``ROUNDS``). A query's nearest list gives its
``k + 1`` best there and with them a proven lower bound on the score of its
``k + 1`` best over all its lists; the next lists hand back only what reaches
that bound and raise it for the round after.

Largest inner product is turned into least distance by one more coordinate,
``sqrt(M^2 - |x|^2)`` with M the largest norm, for which queries have 0.
Scores are inner products of the original vectors in double precision; vectors
given as floats are stored and moved as floats.

Copies collapse first: an index entry is a distinct vector with its
``k + 1`` smallest ids, which is all that any query can need of a group of
copies; equal query vectors are searched once.

The number of lists follows the rows up to a sixteenth of the sample; beyond,
the lists grow. How much of a table a query reads depends on how clustered the
vectors are, as the ratio is fitted to reach the recall.

Rows with a null vec_id, a null vector, one that holds a null or non-finite
component, is zero or has another length than most take no part. Rows that
repeat a vec_id and vector count once. Ties go to the smaller vec_id. With
fewer than k candidates all are returned. An empty table gives no rows. Extra
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayframe.llm.common import bounded_sample, cut

K, SAMPLE, LIST_ROWS, REPLICAS, BORDER, QUERY_ROWS = 20, 20_000, 400, 2, 1.1, 16_384
BLOCK_ROWS, BLOCK_BYTES, GROUPS = 32_768, 16 << 20, 48  # rows and bytes of vectors that a task searches at most, groups at least
ROUNDS = (1, 3, 9)  # lists of a query searched by the end of each round but the last
TARGET_RECALL, CHECKED, STEPS = 0.95, 400, 8  # recall aimed at, sample queries it is measured on, k-means steps


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, vec (array of floats if given so, else of doubles) of the rows that take part."""
    kind = rows.schema["embedding"].dataType.simpleString()
    vec = F.col("embedding").cast(kind if kind == "array<float>" else "array<double>")
    good = rows.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec")).where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()).where(
        F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    )
    sizes = good.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return good.where(F.size("vec") == (sizes[0].d if sizes else 0))


@dataclass
class Index:
    centroids: np.ndarray
    price: np.ndarray  # what a list adds to squared distances for being long
    top: float  # the largest norm
    ratio: float = 1.1
    sizes: np.ndarray | None = None

    def lift(self, x: np.ndarray) -> np.ndarray:
        """Rows with the coordinate that makes all norms equal."""
        rest = np.sqrt(np.maximum(self.top**2 - (x * x).sum(1), 0))
        return np.concatenate((x, rest[:, None]), 1)

    def lists_of(self, x: np.ndarray, block: int = 1024) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and the lists these rows are kept in."""
        rows, lists = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        z = self.lift(x)
        for at in range(0, len(z), block):
            d = np.sqrt(np.maximum(_squares(z[at : at + block], self.centroids) + self.price, 0))
            near = np.argsort(d, axis=1, kind="stable")[:, :REPLICAS]
            dist = np.take_along_axis(d, near, 1)
            row, place = np.nonzero(dist <= BORDER * dist[:, :1])
            rows.append(row + at)
            lists.append(near[row, place])
        return np.concatenate(rows), np.concatenate(lists)

    def search(self, q: np.ndarray, ratio: float | None = None, need: int = (K + 1) * REPLICAS, block: int = 1024) -> list[np.ndarray]:
        """The lists of each query, nearest first: all within the ratio of the nearest, and further ones until they hold ``need`` entries."""
        ratio, out = self.ratio if ratio is None else ratio, []
        z = np.concatenate((q, np.zeros((len(q), 1))), 1)
        for at in range(0, len(z), block):
            d = np.sqrt(_squares(z[at : at + block], self.centroids))
            order = np.argsort(d, axis=1, kind="stable")
            d = np.take_along_axis(d, order, 1)
            sizes = self.sizes[order]
            near = (d <= ratio * d[:, :1]) | (np.cumsum(sizes, 1) - sizes < need)
            out += [row[:n] for row, n in zip(order, near.sum(1))]
        return out


def _halved(x: np.ndarray, ids: np.ndarray, parts: int, rng) -> list[np.ndarray]:
    if parts <= 1 or len(ids) <= 1:
        return [ids]
    part = x[ids] - x[ids].mean(0)
    v = rng.standard_normal(x.shape[1])
    for _ in range(8):  # widest direction by power iteration
        v = part.T @ (part @ v)
        v /= np.linalg.norm(v) or 1.0
    order = ids[np.argsort(part @ v, kind="stable")]
    half = len(order) * (parts // 2) // parts
    return _halved(x, order[:half], parts // 2, rng) + _halved(x, order[half:], parts - parts // 2, rng)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all rows of b."""
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1), 0)


def _centres(z: np.ndarray, lists: int, rng) -> tuple[np.ndarray, np.ndarray]:
    """Balanced centroids and the prices that keep their lists balanced."""
    parts = [p for p in _halved(z, np.arange(len(z)), lists, rng) if len(p)]
    c = np.array([z[p].mean(0) for p in parts])
    price, even = np.zeros(len(c)), len(z) / len(c)
    for _ in range(STEPS if len(c) > 1 else 0):
        d = _squares(z, c)
        mine = np.argmin(d + price, axis=1)
        count = np.bincount(mine, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, mine, z)
        c = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], c)
        price = price + 0.05 * d[np.arange(len(z)), mine].mean() * np.clip(count / even - 1, -1, 1)
    return c, price - price.min()


def build(sample: np.ndarray, top: float, lists: int, k: int = K) -> Index:
    index = Index(np.zeros((0, sample.shape[1] + 1)), np.zeros(0), top)
    z = index.lift(sample)
    rng = np.random.default_rng(11)
    c, index.price = _centres(z, max(1, min(lists, len(z))), rng)
    index.centroids = c
    # The least ratio at which the lists taken hold enough of the sample's own
    # neighbours: a neighbour is found from the ratio of the nearest of its lists on.
    row, kept = index.lists_of(sample)
    index.sizes = np.bincount(kept, minlength=len(c))
    holds = np.zeros((len(sample), len(c)), bool)
    holds[row, kept] = True
    needed = []
    for i in rng.permutation(len(sample))[:CHECKED]:
        score = sample @ sample[i]
        score[i] = -np.inf
        true = np.argsort(-score, kind="stable")[: min(k, len(sample) - 1)]
        far = np.sqrt(((c - np.append(sample[i], 0.0)) ** 2).sum(1))
        needed.append(np.where(holds[true], far / max(far.min(), 1e-300), np.inf).min(1))
    needed = np.sort(np.concatenate(needed)) if needed else np.zeros(0)
    if len(needed):
        index.ratio = float(needed[min(len(needed) - 1, int(np.ceil(TARGET_RECALL * len(needed))))]) * (1 + 1e-9)
    return index


def _vectors(column) -> np.ndarray:
    """An Arrow column of equally long lists as rows of a matrix."""
    if hasattr(column, "combine_chunks"):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1)


def best_of(q: np.ndarray, v: np.ndarray, ids: np.ndarray, least: np.ndarray, k: int, chunk: int = 256):
    """Row of q, row of v, score: for each q its k best rows of v that reach ``least``; ties to the smaller id."""
    rows, cols, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    for at in range(0, len(q), chunk):
        s = q[at : at + chunk] @ v.T
        floor = least[at : at + chunk]
        if len(v) > k and np.isinf(floor).any():
            floor = np.maximum(floor, np.partition(s, -k, axis=1)[:, -k])
        row, col = np.nonzero(s >= floor[:, None])
        score = s[row, col]
        if len(row) and np.bincount(row).max() > k:
            order = np.lexsort((ids[col], -score, row))
            row, col, score = row[order], col[order], score[order]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            row, col, score = row[place < k], col[place < k], score[place < k]
        rows.append(row + at)
        cols.append(col)
        scores.append(score)
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(scores)


def _merged(row: np.ndarray, col: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row its k best of different ids; ties to the smaller id."""
    order = np.lexsort((-score, ids[col], row))
    row, col, score = row[order], col[order], score[order]
    other = np.ones(len(row), bool)
    other[1:] = (row[1:] != row[:-1]) | (ids[col[1:]] != ids[col[:-1]])
    row, col, score = row[other], col[other], score[other]
    order = np.lexsort((ids[col], -score, row))
    row, col, score = row[order], col[order], score[order]
    best = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[best], col[best], score[best]


def fit(entries: DataFrame, sample: int = SAMPLE, list_rows: int = LIST_ROWS, k: int = K) -> Index | None:
    """An index fitted on at most about ``sample`` distinct vectors; None without any."""
    n, top = entries.agg(F.count("*"), F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x))).first()
    if not n:
        return None
    rows = bounded_sample(entries.select("uid", "vec"), "uid", sample).collect()
    rows.sort(key=lambda r: r.uid)
    vectors = np.array([r.vec for r in rows]) if rows else np.array([entries.first().vec])
    return build(vectors, float(np.sqrt(top)), max(1, min(n // list_rows, len(vectors) // 16)), k)


def nearest(rows: DataFrame, is_query, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each row for which ``is_query(vec_id)`` holds."""
    spark = rows.sparkSession
    result = "query_id long, rank int, vec_id long, score double"
    good = usable(rows).distinct()
    kind = good.schema["vec"].dataType.simpleString()
    # the k + 1 smallest ids of each distinct vector; Spark limits the groups before it shuffles them
    few = good.withColumn("n", F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))).where(F.col("n") <= k + 1)
    entries = cut(few.groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).select(F.col("ids")[0].alias("uid"), "ids", "vec"))
    index = fit(entries, k=k)
    if index is None:
        return spark.createDataFrame([], result)

    def place(batches):
        import pyarrow as pa

        for b in batches:
            if b.num_rows:
                row, kept = shared.value.lists_of(_vectors(b.column("vec")))
                t = pa.Table.from_batches([b]).take(pa.array(row)).append_column("list", pa.array(kept.astype(np.int32)))
                yield from t.combine_chunks().to_batches()

    shared = spark.sparkContext.broadcast(index)  # bounded by the sample
    postings = cut(entries.mapInArrow(place, f"uid long, ids array<long>, vec {kind}, list int"))
    sizes = {r.list: r["count"] for r in postings.groupBy("list").count().collect()}  # a row per centroid
    index.sizes = np.array([sizes.get(i, 0) for i in range(len(index.centroids))])
    walker = spark.sparkContext.broadcast(index)
    rows_at_once = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * index.centroids.shape[1])))
    room = min(rows_at_once, max(1, -(-int(index.sizes.sum()) // GROUPS)))
    group_of = (np.cumsum(index.sizes) - index.sizes) // room  # of each list
    blocks = np.maximum(1, -(-np.bincount(group_of, weights=index.sizes).astype(int) // rows_at_once)).tolist()
    rounds = ROUNDS

    def choose(batches):
        import pyarrow as pa

        for b in batches:
            if b.num_rows:
                got = []
                for lists in walker.value.search(_vectors(b.column("qvec")), need=(k + 1) * REPLICAS):
                    asks: dict = {}
                    for r, g, c in zip(np.searchsorted(rounds, np.arange(len(lists)), side="right").tolist(), group_of[lists].tolist(), lists.tolist()):
                        asks.setdefault((r, g), []).append(c)
                    got.append([{"round": r, "group": g, "lists": c} for (r, g), c in asks.items()])
                kinds = pa.list_(pa.struct([("round", pa.int32()), ("group", pa.int32()), ("lists", pa.list_(pa.int32()))]))
                yield pa.record_batch([b.column("quid"), b.column("qvec"), pa.array(got, kinds)], ["quid", "qvec", "asks"])

    asked = good.where(is_query(F.col("vec_id"))).withColumnRenamed("vec_id", "query_id")
    asked = cut(asked.join(entries.select("vec", "uid"), "vec").select("query_id", F.col("uid").alias("quid"), "vec"))
    queries = cut(asked.select("quid", F.col("vec").alias("qvec")).distinct().mapInArrow(choose, f"quid long, qvec {kind}, asks array<struct<round:int,group:int,lists:array<int>>>"))
    counted = queries.select(F.explode("asks").alias("a")).groupBy("a.round", "a.group").count().collect()  # a row per round and group
    of = lambda values, i: F.get(F.array(*[F.lit(int(v)) for v in values]), i)
    placed = postings.withColumn("group", of(group_of, F.col("list"))).withColumn("block", F.pmod(F.xxhash64("uid"), of(blocks, F.col("group"))).cast("int"))

    def match(key, left, right):
        import pyarrow as pa

        kinds = pa.schema([("quid", pa.int64()), ("uid", pa.int64()), ("ids", pa.list_(pa.int64())), ("score", pa.float64())])
        if not (left.num_rows and right.num_rows):
            return kinds.empty_table()
        uid, vecs, held = right.column("uid").to_numpy(), _vectors(right.column("vec")), right.column("list").to_numpy()
        q, least, wanted = _vectors(left.column("qvec")), left.column("least").to_numpy(), left.column("lists").combine_chunks()
        who, wanted = np.repeat(np.arange(len(q)), wanted.value_lengths().to_numpy()), wanted.flatten().to_numpy()
        row, col, score = [], [], []
        for c in np.unique(wanted):
            mine, there = who[wanted == c], np.flatnonzero(held == c)
            r, v, x = best_of(q[mine], vecs[there], uid[there], least[mine], k + 1)
            row.append(mine[r])
            col.append(there[v])
            score.append(x)
        row, col, score = _merged(np.concatenate(row), np.concatenate(col), np.concatenate(score), uid, k + 1)
        ids = right.column("ids").combine_chunks().take(pa.array(col))
        return pa.table([left.column("quid").combine_chunks().take(pa.array(row)), pa.array(uid[col]), ids, pa.array(score)], schema=kinds)

    def search(asks: DataFrame, chunks: list[int]) -> DataFrame:
        """What the lists of ``asks`` (quid, qvec, group, lists, least) hand back."""
        n = of(chunks, F.col("group"))
        asks = asks.withColumn("block", F.explode(F.sequence(F.lit(0), of(blocks, F.col("group")) - 1))).withColumn("chunk", F.pmod(F.xxhash64("quid"), n).cast("int"))
        spread = placed.where(n > 0).withColumn("chunk", F.explode(F.sequence(F.lit(0), n - 1)) if max(chunks) > 1 else F.lit(0))
        keys = ["group", "block", "chunk"]
        return asks.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInArrow(match, "quid long, uid long, ids array<long>, score double")

    # The sums of a product may end differently in another block, so the bound is a little lower.
    kth = F.get(F.sort_array(F.collect_list("score"), asc=False), F.lit(k))  # null in a list of fewer
    found, bound = None, None
    for r in range(len(rounds) + 1):
        chunks = [0] * len(blocks)
        for x in counted:
            if x["round"] == r:
                chunks[x["group"]] = -(-x["count"] // QUERY_ROWS)
        least = queries.withColumn("least", F.lit(None).cast("double")) if bound is None else queries.join(bound, "quid", "left")
        asks = least.select("quid", "qvec", F.coalesce("least", F.lit(float("-inf"))).alias("least"), F.explode(F.filter("asks", lambda a: a["round"] == r)).alias("a"))
        got = search(asks.select("quid", "qvec", "least", "a.group", "a.lists"), chunks)
        if r == len(rounds):
            found = found.union(got)
            break
        # an entry may be in several lists: scores of k + 1 different entries make the bound
        found = cut(got if found is None else found.union(got))
        each = found.groupBy("quid", "uid").agg(F.max("score").alias("score"))
        bound = each.groupBy("quid").agg(F.count("*").alias("n"), kth.alias("s")).where(F.col("n") > k).select("quid", (F.col("s") - F.abs("s") * 1e-9 - 1e-12).alias("least"))
    # a border vector is found in several lists
    one = found.groupBy("quid", "uid").agg(F.max("score").alias("score"), F.first("ids").alias("ids"))
    best = one.withColumn("n", F.row_number().over(Window.partitionBy("quid").orderBy(F.desc("score"), "uid"))).where(F.col("n") <= k + 1)
    pairs = asked.select("query_id", "quid").join(best, "quid").select("query_id", F.explode("ids").alias("vec_id"), "score").where("query_id <> vec_id")
    ranks = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranks.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
