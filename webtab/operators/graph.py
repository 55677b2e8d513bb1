"""Link graph operators: breadth-first walk, next-link chains, degrees.

Each step of a loop writes its small result. The planner then knows its true size, so it broadcasts a small
frontier against the links and shuffles a large one; there are no hard-wired broadcasts but of filters of fixed size.
Links and visited pages are kept divided by address (``layout.Divided``), so a level's joins move the level, not them.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webtab.operators.layout import AddressFilter, Divided
from webtab.session import cut

# the code of the tasks travels with them
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HOT_LINKS = 100_000     # a page with more links is divided into pieces of about so many
PRUNED = 200            # levels of at most so many pages name them, so that only their parts of the links are read
NAMED_LEVELS = 4        # a walk of at most so many levels parses small levels by name, before it parses all pages
FILTERED = 100_000      # from so many visited pages on a filter stands before the join with them
GROUPED = 65_536        # pages of a chain that are followed in one group


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def first_per_group(df: DataFrame, key: str, order: Column, n: int) -> DataFrame:
    """The first ``n`` rows of each ``key``, ordered by ``order``.

    For a small ``n`` Spark itself trims each partition before the shuffle
    (WindowGroupLimit). Above its threshold a hot key is first trimmed in
    salted sub-groups, which keeps the result exact.
    """
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > threshold:
        salted = Window.partitionBy(key, F.pmod(F.xxhash64(order), F.lit(64))).orderBy(order)
        df = df.withColumn("_k", F.row_number().over(salted)).filter(F.col("_k") <= n)
    ranked = df.withColumn("_k", F.row_number().over(Window.partitionBy(key).orderBy(order)))
    return ranked.filter(F.col("_k") <= n).drop("_k")


def bfs(edges: DataFrame, seeds: DataFrame, max_links: int | None = 5, max_depth: int = 3,
        nodes: DataFrame | None = None, last_offers: bool = False) -> tuple[DataFrame, DataFrame]:
    """Level-synchronous breadth-first walk over a table of links.

    ``edges(src, dst, pos[, probe])``: ``pos`` is any type that orders the links
    of a page; ``probe`` is the address tested against the visited pages where it
    differs from ``dst``. ``seeds(url, seed_no)``. ``nodes(url)`` are the pages
    that exist; links to others take a slot but lead nowhere.

    At each level a page offers its first ``max_links`` links not visited at any
    level so far; a page offered twice belongs to the earlier offer. ``path``
    (the link positions from the seed) orders the pages of a level, so no global
    numbering is needed and the result does not depend on partitioning.

    Copies of a link are dropped once, before the walk, and the links are written divided by page; the links of a
    page with very many are divided further, and its row of the frontier is repeated for each piece.

    Returns ``nodes(url, depth, referrer, seed_no, path)`` and the offered links
    ``offers(src, pos, dst)``; those of the deepest pages, which nobody follows,
    are only worked out with ``last_offers``.
    """
    spark = edges.sparkSession
    probed = "probe" in edges.columns
    own = ["dst", "pos", *(["probe"] if probed else [])]
    e = edges.select("src", *own)
    # at most one hot page for every HOT_LINKS links
    hot = e.groupBy("src").agg(F.ceil(F.count("*") / F.lit(HOT_LINKS)).cast("int").alias("pieces")).filter(F.col("pieces") > 1)
    divided, e = not hot.isEmpty(), e.distinct()
    if divided:
        hot = cut(hot, "hot-pages")
        piece = F.pmod(F.xxhash64(*own), F.coalesce("pieces", F.lit(1)))
        e = e.join(hot, "src", "left").withColumn("key", _piece_key(F.col("src"), piece)).drop("pieces", "src")
    else:
        e = e.withColumnRenamed("src", "key")
    links = Divided(spark, "links", "key")
    links.append(e)

    def visit(level: DataFrame, names: list[str] | None) -> DataFrame:
        frontier = level.select("url", "seed_no", "path", F.col("url").alias("key"))
        if divided:
            keyed = frontier.join(hot.withColumnRenamed("src", "url"), "url", "left").withColumn(
                "_piece", F.explode(F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1)))
            frontier = keyed.select("url", "seed_no", "path", _piece_key(F.col("url"), F.col("_piece")).alias("key"))
        found = frontier.join(links.read(None if divided else names), "key").drop("key")
        return found if probed else found.withColumn("probe", F.col("dst"))

    try:
        return _levels(seeds, visit, lambda found: _existing(found, nodes), edges.schema["pos"].dataType.simpleString(), probed,
                       max_links, max_depth, last_offers)
    finally:
        links.forget()


def _piece_key(url: Column, piece: Column) -> Column:
    """The page's address for its first piece; a NUL, which no address holds, and the number for the others."""
    return F.when(piece == 0, url).otherwise(F.concat(url, F.lit("\0"), piece.cast("string")))


def bfs_pages(pages: DataFrame, extract: Callable[[DataFrame], DataFrame],
              links_of: Callable[[DataFrame], DataFrame], seeds: DataFrame,
              max_links: int | None = 5, max_depth: int = 3,
              last_offers: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The same walk over ``pages``, whose links only show once a page is parsed.

    ``extract`` turns pages into records (``url``, ``page_id``, ``copy``, ...),
    ``links_of`` records into ``(url, page_id, copy, links)`` with the list of
    ``(dst, probe)`` of each page, null for pages that only count as visited. All
    pages are parsed once to this narrow table, written divided by ``url``; the walk runs on
    it, and one last scan fetches the records of the visited pages. So the page
    table is read twice, whatever the depth, the fan-out and the size. A walk of at most
    ``NAMED_LEVELS`` levels puts that off: while a level offers at most ``PRUNED`` addresses,
    a scan filtered by them finds its pages, and only those are parsed.

    Returns ``nodes``, ``offers`` and the records of the visited pages. Of several
    copies of a page only the links of the first one count.
    """
    def parsed(some: DataFrame) -> DataFrame:
        rows = links_of(extract(some)).select("url", "page_id", "copy", "links")
        # one row a page and partition goes into the shuffle
        return rows.groupBy("url").agg(F.min_by("links", F.struct("page_id", "copy")).alias("links"))

    table = Divided(pages.sparkSession, "page-links", "url")
    named: DataFrame | None = None      # the pages of the level, as long as levels are small
    whole = max_depth >= NAMED_LEVELS
    if whole:
        table.append(parsed(pages))

    def existing(found: DataFrame) -> DataFrame:
        nonlocal named, whole
        if not whole:
            names = [r["url"] for r in found.select("url").limit(PRUNED + 1).collect()]
            if len(names) <= PRUNED:
                named = cut(parsed(pages.filter(F.col("url").isin(names))), "level-links")
                return _existing(found, named)
            whole = True
            table.append(parsed(pages))
        return _existing(found, table.read())

    def visit(level: DataFrame, names: list[str] | None) -> DataFrame:
        return (level.select("url", "seed_no", "path").join(table.read(names) if whole else named, "url")
                .select("url", "seed_no", "path", F.posexplode("links").alias("pos", "to"))
                .select("url", "seed_no", "path", "to.dst", "pos", "to.probe"))

    try:
        nodes, offers = _levels(seeds, visit, existing, "int", True, max_links, max_depth, last_offers)
    finally:
        table.forget()
    visited = cut(nodes.select("url"), "visited")
    return nodes, offers, cut(extract(pages.join(visited, "url", "left_semi")), "records")


def _levels(seeds: DataFrame, visit: Callable[[DataFrame, list[str] | None], DataFrame],
            existing: Callable[[DataFrame], DataFrame], pos_type: str, probed: bool, max_links: int | None, max_depth: int,
            last_offers: bool) -> tuple[DataFrame, DataFrame]:
    """The levels of a walk. ``visit`` gives the links (url, seed_no, path, dst, pos, probe) of a level, ``existing`` the pages there are."""
    spark = seeds.sparkSession
    found = seeds.dropDuplicates(["url"]).select(
        "url", F.lit(None).cast("string").alias("referrer"), F.col("seed_no").cast("int").alias("seed_no"),
        F.array().cast(f"array<{pos_type}>").alias("path"))
    # all pages visited so far; a level adds to it
    visited, seen, reached, offers = Divided(spark, "visited", "url", "depth"), None, 0, []
    try:
        for depth in range(max_depth + 1):
            visited.append(existing(found).withColumn("depth", F.lit(depth)))
            level = visited.read().filter(F.col("depth") == depth)
            head = [r["url"] for r in level.select("url").limit(PRUNED + 1).collect()]
            if depth and not head or depth == max_depth and not last_offers:
                break
            names = head if len(head) <= PRUNED else None
            reached += len(head) if names is not None else level.count()
            links = visit(level, names)
            if reached < FILTERED:
                # Not an anti join: that would be pushed below the join with the links and test every link of the graph.
                known = visited.read().select(F.col("url").alias("_seen"))
                links = links.join(known, F.col("probe") == F.col("_seen"), "left").filter(F.col("_seen").isNull()).drop("_seen")
            else:
                fresh = level if seen else visited.read()
                seen = seen or AddressFilter(spark)
                seen.add(fresh, "url")
                links = _unvisited(seen.tested(links, "probe"), visited.read())
            if max_links is not None:
                links = first_per_group(links, "url", F.col("pos"), max_links)
            offer = cut(links, "bfs-offer")
            offers.append(offer)
            best = F.min(F.struct("seed_no", F.concat("path", F.array("pos")).alias("path"), F.col("url").alias("referrer")))
            found = offer.groupBy(F.col("dst").alias("_dst")).agg(best.alias("m"))
            if probed:
                found = found.join(visited.read().select(F.col("url").alias("_seen")), F.col("_dst") == F.col("_seen"), "left_anti")
            found = found.select(F.col("_dst").alias("url"), "m.referrer", "m.seed_no", "m.path")
    finally:
        visited.forget()
    nodes = visited.files()
    followed = _union(offers) if offers else nodes.limit(0).select("url", F.lit(None).cast(pos_type).alias("pos"), F.col("url").alias("dst"))
    return (nodes.select("url", "depth", "referrer", "seed_no", "path"),
            followed.select(F.col("url").alias("src"), "pos", "dst"))


def new_links(links: DataFrame, visited: DataFrame) -> DataFrame:
    """Links whose ``probe`` was not visited. Only those the filter is in doubt about are moved to the visited pages."""
    sure = links.filter(~F.col("doubtful")).drop("doubtful")
    doubt = links.filter("doubtful").drop("doubtful")
    return sure.unionByName(doubt.join(visited.select(F.col("url").alias("_seen")), F.col("probe") == F.col("_seen"), "left_anti"))


def _unvisited(links: DataFrame, visited: DataFrame) -> DataFrame:
    """The same as ``new_links`` where nearly all links may lead to visited pages: links are not moved, nor written, to find that out.

    The probes that the filter is in doubt about are written alone and the different ones compared with the visited pages. Those that
    stay are the few that the filter was wrong about, as a rule, and the links are read again for them.
    """
    probes = cut(links.filter("doubtful").select("probe"), "bfs-links")
    new = cut(new_links(probes.distinct().withColumn("doubtful", F.lit(True)), visited), "bfs-new")
    sure, doubt = (links.filter(test).drop("doubtful") for test in (~F.col("doubtful"), F.col("doubtful")))
    return sure if new.isEmpty() else sure.unionByName(doubt.join(new, "probe", "left_semi"))


def _existing(found: DataFrame, nodes: DataFrame | None) -> DataFrame:
    if nodes is None:
        return found
    # inner join so that the small side, the new level, can be the broadcast one
    return nodes.select("url").join(found, "url").dropDuplicates(["url"]).select(found.columns)


def walk_order() -> list[Column]:
    return [F.col("depth"), F.col("seed_no"), F.col("path")]


def in_order(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """``df`` written in the order given, with ``_part`` and ``_at`` (place in the part): parts follow each other, too."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    return cut(ranged.withColumns({"_part": F.shiftright("_place", 33), "_at": F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))})
               .drop("_place"), label)


def first_items(df: DataFrame, order: list[Column], limit: int) -> DataFrame:
    """Stop after ``limit`` items in walk order; 0 means no limit.

    A distributed selection: rows are divided into ranges of the order and counted by range; sums of the counts say
    which ranges are in as a whole and how much of the next one is. No task takes more than its range, whatever the limit.
    """
    if not limit:
        return df
    ranged = in_order(df, order, "first-items")
    left, last = limit, None
    # one count for each range
    for r in ranged.groupBy("_part").agg(F.count("*").alias("n")).orderBy("_part").collect():
        if left <= r["n"]:
            last = r["_part"]
            break
        left -= r["n"]
    kept = F.lit(True) if last is None else (F.col("_part") < last) | (F.col("_part") == last) & (F.col("_at") < left)
    return ranged.filter(kept).drop("_part", "_at")


# ---- next-link chains ---------------------------------------------------------------
PARTS = "entry string, url string, place int, previous string, to string"


def follow_chain(edges: DataFrame, seeds: DataFrame, max_hops: int | None = None) -> DataFrame:
    """Follow the one next-link of each page until it ends or repeats.

    ``edges(src, dst[, page_id])``, ``seeds(seed, url[, more])`` -> ``(seed, url, hop, previous[, more])``: ``previous`` is
    the page before, and further columns of the seeds travel along. Of
    several links of one page that of the smallest ``page_id`` counts (a null
    ``dst`` says that the page has none).

    List ranking: pages are grouped by folder and page number, which most chains keep to, and a group is followed at one
    go; its entries (seeds, targets of links from other groups, pages that several link to) divide the
    chains into stretches. The short list of stretches is then ranked by doubling, from the seeds only, and the
    ranks are pushed back to the pages of the stretches that were reached. Groups are bounded, a crowded folder
    is divided further; chains that jump from group to group are still followed, by more rounds of doubling.
    """
    more = [c for c in seeds.columns if c not in ("seed", "url")]
    first = F.min(F.struct("page_id", "dst"))["dst"] if "page_id" in edges.columns else F.min("dst")
    step = cut(edges.groupBy("src").agg(first.alias("dst")).filter(F.col("dst").isNotNull()), "chain-steps")
    starts = seeds.dropDuplicates(["seed", "url"]).select("seed", "url", F.lit(0).alias("hop"),
                                                          F.lit(None).cast("string").alias("previous"), *more)
    parts = cut(_stretches(step, starts), "chain-stretches")
    jump = parts.filter(F.col("to").isNotNull()).select(F.col("entry").alias("src"), F.col("to").alias("dst"),
                                                        (F.col("place") + 1).alias("length"), F.col("url").alias("via"))
    reached = [starts]
    while not jump.isEmpty():
        so_far = _union(reached)
        new = so_far.drop("previous").join(jump, F.col("url") == F.col("src")).select(
            "seed", F.col("dst").alias("url"), F.struct((F.col("hop") + F.col("length")).alias("hop"), F.col("via").alias("previous"), *more).alias("r"))
        if max_hops is not None:
            new = new.filter(F.col("r.hop") <= max_hops)
        new = (new.groupBy("seed", "url").agg(F.min_by("r", "r.hop").alias("r")).select("seed", "url", "r.*")
               .join(so_far.select("seed", "url"), ["seed", "url"], "left_anti"))
        new = cut(new, "chain-part")
        if new.isEmpty():
            break
        reached.append(new)
        onward = jump.select(F.col("src").alias("dst"), F.col("dst").alias("dst2"), F.col("length").alias("length2"), F.col("via").alias("via2"))
        jump = cut(jump.join(onward, "dst").select("src", F.col("dst2").alias("dst"), (F.col("length") + F.col("length2")).alias("length"),
                                                   F.col("via2").alias("via")), "chain-jump")
    entries = _union(reached).withColumnsRenamed({"url": "entry", "previous": "before"})
    found = entries.join(parts.drop("to"), "entry").select(
        "seed", "url", (F.col("hop") + F.col("place")).alias("hop"), F.coalesce("previous", "before").alias("previous"), *more)
    return found if max_hops is None else found.filter(F.col("hop") <= max_hops)


def _home(url: Column) -> Column:
    """Folder of an address and the range of its last number."""
    number = F.regexp_extract(url, r"([0-9]{1,9})[^0-9]*$", 1).try_cast("long")
    return F.xxhash64(F.regexp_extract(url, r"^(.*)/", 1), F.shiftright(F.coalesce(number, F.lit(0)), 12))


def _stretches(step: DataFrame, starts: DataFrame) -> DataFrame:
    """``PARTS`` of every stretch: its pages with their places, and on the last one the entry that follows, if any."""
    if step.count() <= GROUPED:
        homed = step.withColumns({"home": F.lit(0).cast("long"), "to_home": F.lit(0).cast("long")})
        begun = starts.select(F.lit(0).cast("long").alias("home"), "url")
    else:
        homed = step.withColumns({"home": _home(F.col("src")), "to_home": _home(F.col("dst"))})
        # at most one crowded group for every GROUPED pages
        crowded = cut(homed.groupBy("home").agg(F.ceil(F.count("*") / F.lit(GROUPED)).alias("pieces")).filter(F.col("pieces") > 1), "chain-crowded")

        def divided(df: DataFrame, home: str, url: str) -> DataFrame:
            own = crowded.withColumnRenamed("home", home)
            piece = F.xxhash64(home, F.pmod(F.xxhash64(url), F.col("pieces")))
            return df.join(own, home, "left").withColumn(home, F.when(F.col("pieces").isNotNull(), piece).otherwise(F.col(home))).drop("pieces")
        homed = cut(divided(divided(homed, "home", "src"), "to_home", "dst"), "chain-homes")
        begun = divided(starts.select(_home(F.col("url")).alias("home"), "url"), "home", "url")
    inside = homed.select("home", F.col("src").alias("url"), "dst", (F.col("home") == F.col("to_home")).alias("stays"))
    entered = homed.filter(F.col("home") != F.col("to_home")).select(F.col("to_home").alias("home"), F.col("dst").alias("url"))
    marks = entered.unionByName(begun.select("home", "url")).distinct().withColumns(
        {"dst": F.lit(None).cast("string"), "stays": F.lit(None).cast("boolean")})
    return inside.unionByName(marks.select(inside.columns)).groupBy("home").applyInArrow(_followed, PARTS)


def _followed(group: pa.Table) -> pa.Table:
    """The stretches of a group. ``stays`` is null on entries, and tells of links whether they stay in the group."""
    onward, entries, linked = {}, set(), set()
    for url, dst, stays in zip(*(group[c].to_pylist() for c in ("url", "dst", "stays")), strict=True):
        if stays is None:
            entries.add(url)
            continue
        onward[url] = dst, stays
        if stays:
            if dst in linked:
                entries.add(dst)
            linked.add(dst)
    rows = []
    for entry in sorted(entries):
        url, place, before = entry, 0, None
        while True:
            dst, stays = onward.get(url, (None, True))
            ends = not stays or dst in entries
            rows.append((entry, url, place, before, dst if ends else None))
            if ends or dst is None:
                break
            url, place, before = dst, place + 1, url
    columns = list(zip(*rows, strict=True)) or [()] * 5
    return pa.table({name: pa.array(column, pa.int32() if name == "place" else pa.string())
                     for name, column in zip(("entry", "url", "place", "previous", "to"), columns, strict=True)})


def degrees(edges: DataFrame, unique: bool = False) -> DataFrame:
    """Distinct out- and in-links of every page, in one pass over the edges.

    ``unique`` says that no edge is repeated, which saves a shuffle.
    """
    pairs = edges.select("src", "dst")
    ends = (pairs if unique else pairs.distinct()).select(F.explode(F.array(
        F.struct(F.col("src").alias("url"), F.lit(1).alias("o"), F.lit(0).alias("i")),
        F.struct(F.col("dst").alias("url"), F.lit(0).alias("o"), F.lit(1).alias("i")))).alias("e"))
    return ends.groupBy("e.url").agg(F.sum("e.o").alias("out_links"), F.sum("e.i").alias("in_links"))
