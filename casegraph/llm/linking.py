"""Links and components of similar sets, found by an inverted join of signatures.

Each set has a signature: coordinates with one value each. A set is posted under
its coordinate-value pairs; two sets collide once per pair that they share, and
a pair of sets is a candidate if it collides on min_shared coordinates or more.
Two such sets meet in what is left of each signature when all but its
(size - min_shared + 1) rarest pairs are skipped (prefix merging), so only these
are posted; values that one set alone has count among them and post nothing.

Equal sets are one class from the start. The members of short lists are paired
and verified. Long lists are cut into blocks; a task gets two blocks, compares
their signatures at once, verifies what it hasn't joined yet, most alike first,
and returns no more links than join them. The members of lists of several blocks
aren't paired with each other at first: in rounds, each is held against the
leaders of its lists, the best of which is verified on the full sets, and what
verifies merges components; only lists that still hold several go on. So each link either is verified or joins what is joined already.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from casegraph.operators.graph import connected_components, discard, durable, release, stored

#: Members of a posting list or followers of a leader that one task gets at once.
FOLLOWERS = 2048
#: Elements of the sets of one block, so that a task's memory is bounded where sets are large (8 bytes each).
ELEMENTS = 1 << 20
#: Lists up to this length are paired directly.
SHORT = 48
#: Rounds of leaders for lists of several blocks, at most.
ROUNDS = 3


def similar(inter: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    return 100 * inter >= percent * (n_a + n_b - inter)


def size_fits(n_a: Column, n_b: Column, percent: int) -> Column:
    """Sets whose sizes differ too much can't be similar."""
    return (100 * F.least(n_a, n_b)) >= (percent * F.greatest(n_a, n_b))


def postings(reps: DataFrame, min_shared: int) -> DataFrame:
    """(token, id, n) of the prefixes of (id, n, keys), by rising frequency of the tokens; each token stands in several sets.

    Frequencies are partial aggregations and the join with them is one that Spark
    splits, so a token that a third of all sets share isn't one task's.
    """
    tokens = reps.select("id", "n", F.size("keys").alias("_k"), F.posexplode("keys").alias("_pos", "_value"))
    tokens = tokens.select("id", F.col("n").cast("int").alias("n"), F.col("_k").cast("short").alias("_k"), F.xxhash64("_pos", "_value").alias("token"))
    shared = stored(tokens.groupBy("token").agg(F.count("*").alias("_f")).where("_f > 1"))
    release(reps.sparkSession)
    if min_shared == 1:
        return stored(tokens.join(shared.select("token"), "token").select("token", "id", "n"))
    met = tokens.join(shared, "token")
    mine = met.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("_f", "token"))).alias("_all"), F.max("n").alias("n"), F.max("_k").alias("_k"))
    # _all leaves out the tokens that no other set has; they are the rarest
    room = F.greatest(F.col("_k") - F.lit(min_shared) + 1 - (F.col("_k") - F.size("_all")), F.lit(0))
    lists = stored(mine.select("id", "n", F.explode(F.slice("_all", F.lit(1), room)).alias("_t")).select(F.col("_t.token").alias("token"), "id", "n"))
    busy = stored(lists.groupBy("token").agg(F.min("id").alias("_low"), F.max("id").alias("_high")).where("_low <> _high").select("token"))
    out = stored(lists.join(busy, "token").select("token", "id", "n"))
    discard(shared, lists, busy)
    return out


def collisions(pairs: DataFrame, reps: DataFrame, min_shared: int) -> DataFrame:
    """Pairs (a, b) of which min_shared coordinates or more agree, and how many do."""
    left = reps.select(F.col("id").alias("a"), F.col("keys").alias("_ka"))
    right = reps.select(F.col("id").alias("b"), F.col("keys").alias("_kb"))
    agree = F.size(F.filter(F.zip_with("_ka", "_kb", lambda x, y: x == y), lambda x: x))
    return pairs.join(left, "a").join(right, "b").select("a", "b", agree.alias("agree")).where(F.col("agree") >= min_shared)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets are similar. Followers a of one leader b are dealt to several tasks."""
    leaders = durable(pairs.groupBy("b").agg(F.ceil(F.count("*") / FOLLOWERS).cast("int").alias("_k")))
    right = leaders.join(sets.select(F.col("id").alias("b"), F.col("set").alias("_sb")), "b").select("b", "_sb", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)).alias("_salt"))
    left = pairs.join(leaders, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("_k")).cast("int").alias("_salt"))
    left = left.join(sets.select(F.col("id").alias("a"), F.col("set").alias("_sa")), "a")
    both = left.join(right, ["b", "_salt"])
    inter = F.size(F.array_intersect("_sa", "_sb"))
    return both.where(similar(inter, F.size("_sa"), F.size("_sb"), percent)).select("a", "b").distinct()


def _block(table: pa.Table, min_shared: int, percent: int) -> pa.Table:
    """Links between the two blocks of one list, as many as join components."""
    size = table["n"].to_numpy()
    ids, token = table["id"].to_numpy(), table["token"][0].as_py()
    keys = table["keys"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
    part = table["_part"].to_numpy()
    lists = table["tokens"].combine_chunks()
    holder = np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy()))
    other = lists.flatten().to_numpy()
    lower = other < token
    distinct, code, count = np.unique(other[lower], return_inverse=True, return_counts=True)
    common = np.full(len(distinct), -1)
    common[count > 1] = np.arange((count > 1).sum())
    # smaller tokens, under which a pair is met instead, as bits
    met = np.zeros((len(ids), max((count > 1).sum(), 1) // 8 + 1), np.uint8)
    hit = common[code] >= 0
    np.bitwise_or.at(met, (holder[lower][hit], common[code][hit] // 8), (1 << (common[code][hit] % 8)).astype(np.uint8))
    sets = table["set"].combine_chunks()
    begin, flat = sets.offsets.to_numpy(), sets.flatten().to_numpy()
    flat, begin = flat, begin - begin[0]
    elements, place = np.unique(flat, return_inverse=True)
    width = len(elements) // 8 + 1
    root = {}

    def find(c):
        while root.setdefault(c, c) != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    component = table["component"].to_numpy()
    left, right = np.flatnonzero(part != 1), np.flatnonzero(part != 0)
    bits: dict[int, np.ndarray] = {}

    def row(i: int) -> np.ndarray:
        if i not in bits:
            if len(bits) * width > 32 << 20:
                bits.clear()
            own = np.zeros(width * 8, bool)
            own[place[begin[i] : begin[i + 1]]] = True
            bits[i] = np.packbits(own)
        return bits[i]

    out = []
    for at in range(0, len(left), 128):
        a = left[at : at + 128]
        agree = np.zeros((len(a), len(right)), np.int16)
        for k in range(keys.shape[1]):
            agree += keys[a, k][:, None] == keys[right, k][None, :]
        ok = (agree >= min_shared) & (component[a][:, None] != component[right][None, :])
        ok &= (100 * np.minimum(size[a][:, None], size[right][None, :])) >= (percent * np.maximum(size[a][:, None], size[right][None, :]))
        if (part == 2).all():
            ok &= ids[a][:, None] < ids[right][None, :]
        i, j = np.nonzero(ok)
        part_size = max(1, (4 << 20) // met.shape[1])
        apart = [~(met[a[i[x : x + part_size]]] & met[right[j[x : x + part_size]]]).any(1) for x in range(0, len(i), part_size)]
        if apart:
            i, j = i[np.concatenate(apart)], j[np.concatenate(apart)]
        order = np.argsort(-agree[i, j], kind="stable")
        i, j = a[i[order]], right[j[order]]
        step = max(1, (4 << 20) // width)
        while len(i):
            x, y = i[:step], j[:step]
            inter = np.bitwise_count(np.array([row(k) for k in x]) & np.array([row(k) for k in y])).sum(1, dtype=np.int64)
            for p, q in zip(x[good := 100 * inter >= percent * (size[x] + size[y] - inter)], y[good]):
                u, v = find(int(component[p])), find(int(component[q]))
                if u != v:
                    root[max(u, v)] = min(u, v)
                    out.append((ids[p], ids[q]))
            i, j = i[step:], j[step:]
            if len(i):
                now = {c: find(c) for c in set(component[i].tolist()) | set(component[j].tolist())}
                apart = np.array([now[c] for c in component[i].tolist()]) != np.array([now[c] for c in component[j].tolist()])
                i, j = i[apart], j[apart]
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([x for _, x in out], pa.int64())})


def block_links(long: DataFrame, lists: DataFrame, signs: DataFrame, sets: DataFrame, min_shared: int, percent: int) -> DataFrame:
    """Links (a, b) inside long lists (token, id, component, _size, _elements), by pairs of blocks of bounded rows and elements."""
    blocks = F.ceil(F.greatest(F.col("_size") / FOLLOWERS, F.col("_elements") / ELEMENTS)).cast("int")
    members = long.withColumn("_blocks", blocks).withColumn("_own", F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int"))
    members = members.select("token", "id", "component", "_own", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other"))
    members = members.select("token", "id", "component", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"), F.when(F.col("_own") == F.col("_other"), 2).when(F.col("_own") < F.col("_other"), 0).otherwise(1).alias("_part"))
    whole = lists.join(long.select("id").distinct(), "id", "left_semi").groupBy("id").agg(F.collect_list("token").alias("tokens"))
    data = signs.select("id", "n", "keys").join(whole, "id").join(sets, "id")
    rows = members.join(data, "id")
    return rows.groupBy("token", "_i", "_j").applyInArrow(lambda t: _block(t, min_shared, percent), "a long, b long")


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels (id, component) after links (a, b) between ids."""
    of = lambda c: labels.select(F.col("id").alias(c), F.col("component").alias(f"_c{c}"))
    between = links.join(of("a"), "a").join(of("b"), "b").select("_ca", "_cb").distinct()
    new = durable(connected_components(between, "_ca", "_cb")).select(F.col("id").alias("component"), F.col("component").alias("_new"))
    return durable(labels.join(new, "component", "left").select("id", F.coalesce("_new", "component").alias("component")))


def components(items: DataFrame, sets_of: Callable[[DataFrame], DataFrame], min_shared: int, percent: int, kept: bool = False) -> DataFrame:
    """(id, n, component) for each row of items (id, n, h1, h2, keys); kept tells that items is a stored table.

    n is the set's size and (h1, h2) its hash; keys is its signature. sets_of(ids)
    gives (id, set) for a table of ids. Rows that share an id are one item, linked
    by any of their sets; items without elements (n = 0) are linked with nothing.
    """
    items = items if kept else stored(items)
    classes = stored(items.where("n > 0").groupBy("n", "h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("_c")).where("_c > 1").drop("_c"))
    # rows that the first of an equal set stands for; all others stand for themselves
    copies = stored(items.select("id", "n", "h1", "h2").join(classes, ["n", "h1", "h2"]).where("id <> rep").distinct())
    release(items.sparkSession)
    reps = stored(items.where("n > 0").join(copies, ["id", "n", "h1", "h2"], "left_anti").select("id", "n", "keys").dropDuplicates(["id", "n", "keys"]))
    release(items.sparkSession)
    lists = postings(reps, min_shared)
    involved = stored(lists.select("id").distinct())
    release(items.sparkSession)
    sets = stored(sets_of(involved))
    labels = durable(involved.select("id", F.col("id").alias("component")))
    signs = stored(reps.join(involved, "id", "left_semi"))
    for turn in range(ROUNDS):
        placed = lists.join(labels, "id")
        groups = durable(placed.groupBy("token").agg(
            F.min("component").alias("_low"), F.max("component").alias("_high"), F.count("*").alias("_size"),
            F.min(F.struct(F.xxhash64(F.lit(turn), "id").alias("_h"), F.col("id").alias("b"), F.col("n").alias("_nb"), F.col("component").alias("_cb"))).alias("_lead"),
        ).where((F.col("_low") != F.col("_high")) & (F.col("_size") > FOLLOWERS)))
        if groups.isEmpty():
            break
        held = placed.join(groups.select("token", "_lead.b", "_lead._nb", "_lead._cb"), "token")
        pairs = held.where((F.col("component") != F.col("_cb")) & size_fits(F.col("n"), F.col("_nb"), percent)).select(F.col("id").alias("a"), "b").distinct()
        best = collisions(pairs, signs, min_shared).groupBy("a").agg(F.max_by("b", F.struct("agree", "b")).alias("b"))
        labels = merged(labels, durable(verified(durable(best.select("a", "b")), sets, percent)))
    placed = durable(lists.join(labels, "id"))
    groups = durable(placed.groupBy("token").agg(F.min("component").alias("_low"), F.max("component").alias("_high"), F.count("*").alias("_size"), F.sum("n").alias("_elements")).where("_low <> _high").select("token", "_size", "_elements"))
    some = placed.join(groups.where(F.col("_size") <= SHORT).select("token"), "token")
    x, y = some.alias("x"), some.alias("y")
    meet = (F.col("x.token") == F.col("y.token")) & (F.col("x.id") < F.col("y.id")) & (F.col("x.component") != F.col("y.component")) & size_fits(F.col("x.n"), F.col("y.n"), percent)
    pairs = x.join(y, meet).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()
    links = verified(durable(collisions(pairs, signs, min_shared).select("a", "b")), sets, percent)
    long = placed.join(groups.where(F.col("_size") > SHORT), "token")
    links = durable(links.union(block_links(long, lists, signs, sets, min_shared, percent)))
    labels = merged(labels, links)
    discard(sets, signs, reps, lists)
    of = labels.select(F.col("id").alias("rep"), "component")
    plain = items.select("id", "n", "h1", "h2").join(copies, ["id", "n", "h1", "h2"], "left")
    return plain.select("id", "n", F.coalesce("rep", "id").alias("rep")).join(of, "rep", "left").select("id", "n", F.coalesce("component", "rep").alias("component"))
