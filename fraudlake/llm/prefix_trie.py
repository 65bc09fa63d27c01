"""The trie of conversations that share their first turns.

**Turns.** A turn's id is a digest of role and text (96 bits) and the text's length in code
points. A conversation's turns are in order of ``turn`` (null first), equal ones by their id. A
conversation c is rebuilt from the first h turns of conversation c - c % 100 and its own turns
after its first h, h = crc32(c) % 6.

**Blocks.** A conversation's turn ids stand in blocks of ``COLUMNS`` positional columns t1, t2,
...; a block is keyed by the node that the blocks before it lead to, a digest chained over them,
so all blocks of all conversations are aggregated at once, however long they are.

**ROLLUP.** Equal conversations are first counted as one. ``GROUP BY block, prior, ROLLUP(t1,
...)`` then gives every prefix a row, and ``grouping_id`` tells its length: members, smallest
member, and the digest that names the node. A second ROLLUP over the same columns adds up
subtrees: a node's own share stands on the row of its smallest member, which passes through
all the node's ancestors, and so do the shares of deeper nodes.

**Ends.** Members that end at a node are put in order by range over (node, conversation), written
out as pieces of ``PIECE`` ids, and the pieces of a node hashed as a stream: no list of a node's
members is ever held. A parent with many children is no hot key: its row is found by the
pre-aggregated look-up.

Rows: one for each node, the root included. Null role and text are empty; repeated rows are
turns of their own; rows without ``conv_id`` belong to no conversation and are left out; an
empty table has no conversation, hence no node. ``%`` keeps the sign of c. Other columns are not
looked at. One conversation is put in order by one task, which spills, as narrow rows.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import lookup
from ..session import materialize

COLUMNS = 8
PIECE = 4096
SHARED = 100
HEADS = 6
ROOT = b""
EMPTY = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, id): the turns of each conversation, numbered from 0."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(" "), role, text).cast("binary"))
    made = F.unhex(F.concat(F.substring(digest, 1, 24), F.lpad(F.hex(F.length(text)), 8, "0")))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long"), "turn", made.alias("id"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "id")
    return rows.select("conv_id", (F.row_number().over(order) - 1).alias("place"), "id")


def rebuilt(numbered: DataFrame) -> DataFrame:
    """(conv_id, part, place, id): part 0 holds the turns taken over, part 1 the own ones; a row
    with part -1 for each conversation, so that one without turns is there too."""
    heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    own = numbered.where(F.col("place") >= heads).select("conv_id", F.lit(1).alias("part"), "place", "id")
    first = (numbered.where((F.col("conv_id") % SHARED == 0) & (F.col("place") < HEADS - 1)).groupBy("conv_id")
             .agg(F.sort_array(F.collect_list(F.struct("place", "id"))).alias("first")))  # at most five turns
    # every conversation has a row at place 0; one base serves at most 199 conversations
    all_ids = numbered.where("place = 0").select("conv_id", (F.col("conv_id") - F.col("conv_id") % SHARED).alias("base"))
    taken = all_ids.join(first.withColumnRenamed("conv_id", "base"), "base", "left").select(
        "conv_id", F.explode(F.concat(
            F.array(F.struct(F.lit(-1).alias("part"), F.lit(0).alias("place"), F.lit(b"").alias("id"))),
            F.transform(F.filter(F.coalesce("first", F.expr("cast(array() as array<struct<place:int,id:binary>>)")),
                                 lambda t: t["place"] < heads),
                        lambda t: F.struct(F.lit(0).alias("part"), t["place"].alias("place"), t["id"].alias("id")))
        )).alias("t")).select("conv_id", "t.*")
    return taken.unionByName(own)


def blocks(rows: DataFrame, columns: int) -> DataFrame:
    """(conv_id, block, prior, t1..tn, n, last, node): a row for each block of a conversation;
    ``last`` marks the one it ends in, at ``node``."""
    names = [f"t{i + 1}" for i in range(columns)]

    def run(batches):
        conv, prior, held, number, out = None, ROOT, [], 0, []

        def row(last):
            return (conv, number, prior, *held, *[None] * (columns - len(held)), len(held), last,
                    hashlib.md5(prior + b"".join(held)).digest() if held else prior)

        def batch():
            kinds = [pa.int64(), pa.int32(), *[pa.binary()] * (columns + 1), pa.int32(), pa.bool_(), pa.binary()]
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                              ["conv_id", "block", "prior", *names, "n", "last", "node"])
            out.clear()
            return made

        for part in batches:
            for c, p, turn in zip(*(part.column(x).to_pylist() for x in ("conv_id", "part", "id"))):
                if c != conv:
                    if conv is not None:
                        out.append(row(True))
                    conv, prior, held, number = c, ROOT, [], 0
                if p < 0:
                    continue
                if len(held) == columns:
                    out.append(row(False))
                    prior, held, number = out[-1][-1], [], number + 1
                held.append(turn)
            if len(out) > 5000:
                yield batch()
        if conv is not None:
            out.append(row(True))
        if out:
            yield batch()

    fields = ", ".join(f"{c} binary" for c in ("prior", *names))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place").mapInArrow(
        run, f"conv_id long, block int, {fields}, n int, last boolean, node binary")


def ends(members: DataFrame) -> DataFrame:
    """(node, ends_sha256) for (node, conv_id): the hash of the ascending ids, comma-joined."""
    def pieces(batches):
        node, ids = None, []

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([node], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])],
                ["node", "first", "ids"])

        for batch in batches:
            for name, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
                if ids and (name != node or len(ids) == PIECE):
                    yield row()
                    ids = []
                node = name
                ids.append(conv)
        if ids:
            yield row()

    def hashes(batches):
        node, state = None, None
        for batch in batches:
            done = []
            for name, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                if name == node:
                    state.update(b"," + ids.encode())
                    continue
                if state:
                    done.append((node, state.hexdigest()))
                node, state = name, hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["node", "ends_sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([state.hexdigest()])], ["node", "ends_sha256"])

    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = members.repartitionByRange(parts, "node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(
        pieces, "node binary, first long, ids string")
    return cut.repartition("node").sortWithinPartitions("node", "first").mapInArrow(hashes, "node binary, ends_sha256 string")


def _rollup(rows: DataFrame, columns: int, sums: str) -> DataFrame:
    """ROLLUP over the positional columns; ``level`` says how many of them a row is grouped by.
    Level 0 is the node before the block, known from the block before, but for the root."""
    names = ", ".join(f"t{i + 1}" for i in range(columns))
    # absent columns have grouping bits from the right: 0b00..011 is all but the last two
    level = f"{columns} - cast(round(log2(grouping_id(block, prior, {names}) + 1)) as int)"
    made = rows.sparkSession.sql(
        f"select block, prior, {names}, {level} as level, {sums} from {{rows}} group by block, prior, rollup({names})",
        rows=rows)
    last = F.coalesce(*[F.when(F.col("level") == i + 1, F.col(f"t{i + 1}")) for i in range(columns)])
    # a prefix that ends before column i is grouped by it in vain
    return made.withColumn("own", last).where("(level = 0 and block = 0) or own is not null")


def _node(columns: int, less: int = 0):
    """The digest of the node at ``level`` - ``less`` in its block."""
    cells = [F.when(F.col("level") - less > i, F.col(f"t{i + 1}")).otherwise(F.lit(b"")) for i in range(columns)]
    return F.when(F.col("level") - less <= 0, F.col("prior")).otherwise(F.unhex(F.md5(F.concat("prior", *cells))))


def trie(conversations: DataFrame, columns: int = COLUMNS) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    names = [f"t{i + 1}" for i in range(columns)]
    rows = materialize(blocks(rebuilt(materialize(turns(conversations))), columns))
    alike = materialize(rows.groupBy("block", "prior", *names, "last", "n").agg(
        F.count("*").alias("members"), F.min("conv_id").alias("smallest")))

    nodes = _rollup(alike, columns, "sum(members) as n_convs, min(smallest) as conv_id").select(
        "conv_id", (F.col("block") * columns + F.col("level")).cast("long").alias("depth"), "block", "level", "n_convs",
        _node(columns).alias("node"), F.when(F.col("level") > 0, _node(columns, 1)).alias("parent"),
        ((F.col("n_convs") - 1) * F.coalesce(F.conv(F.right(F.hex("own"), F.lit(8)), 16, 10).cast("long"),
                                             F.lit(0))).alias("saved"))
    nodes = materialize(nodes)
    children = nodes.where("parent is not null").groupBy("parent").agg(F.count("*").alias("n_children"))
    nodes = materialize(nodes.join(children.withColumnRenamed("parent", "node"), "node", "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0).cast("long"))))

    # a node's share on the row of its smallest member, by place in the block
    def at(i, value):
        return F.sum(F.when(F.col("level") == i, value).otherwise(F.lit(0)))

    levels = range(columns + 1)
    shares = nodes.groupBy("conv_id", "block").agg(
        *[at(i, F.col("saved")).alias(f"s{i}") for i in levels],
        *[at(i, (F.col("n_children") == 0).cast("long")).alias(f"l{i}") for i in levels])
    # the smallest members end somewhere as the smallest too, so they are those of ``alike``
    whole = [f"{x}{i}" for x in "sl" for i in levels]
    passed = shares.select("conv_id").distinct()
    paths = (rows.join(passed, "conv_id", "left_semi").select("conv_id", "block", "prior", *names)
             .join(shares, ["conv_id", "block"], "left").fillna(0, whole))
    later = Window.partitionBy("conv_id").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    total = {x: sum((F.col(f"{x}{i}") for i in levels), F.lit(0)) for x in "sl"}
    after = {x: F.coalesce(F.sum(total[x]).over(later), F.lit(0)) for x in "sl"}
    paths = paths.select("*", *[after[x].alias(f"{x}_after") for x in "sl"])
    # what lies at a place or after it
    tails = {f"{x}_{i}": sum((F.col(f"{x}{j}") for j in range(i, columns + 1)), F.col(f"{x}_after"))
             for x in "sl" for i in levels}
    paths = paths.select("block", "prior", *names, *[e.alias(n) for n, e in tails.items()])
    under = _rollup(paths, columns, ", ".join(f"sum({n}) as {n}" for n in tails))

    def of_level(x):
        return F.coalesce(*[F.when(F.col("level") == i, F.col(f"{x}_{i}")) for i in levels])

    under = under.select(_node(columns).alias("node"), of_level("s").alias("saved_tokens"), of_level("l").alias("n_leaves"))
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.join(under, "node").join(ends(rows.where("last").select("node", "conv_id")), "node", "left")
    found = lookup(materialize(found), parents, ["parent"])
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))


_CRC = """list_reduce(list_concat([4294967295::UBIGINT], [ascii(x)::UBIGINT for x in string_split(c::VARCHAR, '')]),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0::UBIGINT for i in range(8)]),
        lambda x, z: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END)))"""
CHECK = f"""
WITH own AS (SELECT conv_id AS c, turn, struct_pack(d := md5(length(r) || ' ' || r || t), n := length(t)) AS id
    FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations)
    WHERE conv_id IS NOT NULL),
paths AS (SELECT c, list(id ORDER BY turn NULLS FIRST, id.d[1:24], id.n) AS path FROM own GROUP BY c),
heads AS (SELECT c, c - c % {SHARED} AS base, path, (xor({_CRC}, 4294967295::UBIGINT) % {HEADS})::BIGINT AS h FROM paths),
whole AS (SELECT a.c, list_concat(coalesce(b.path[1:a.h], a.path[1:0]), a.path[a.h + 1:]) AS path
    FROM heads a LEFT JOIN paths b ON b.c = a.base),
members AS (SELECT c, path[1:d] AS node, d = len(path) AS ends_here FROM whole, unnest(range(0, len(path) + 1)) AS u(d)),
nodes AS (SELECT node, min(c) AS c, count(*) AS n_convs,
        coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends_here), '') AS ends FROM members GROUP BY node),
children AS (SELECT node[1:len(node) - 1] AS node, count(*) AS n FROM nodes WHERE len(node) > 0 GROUP BY 1),
own_share AS (SELECT a.node, (n_convs - 1) * coalesce(a.node[len(a.node)].n, 0) AS saved, (b.n IS NULL)::INT AS leaf
    FROM nodes a LEFT JOIN children b ON a.node = b.node),
under AS (SELECT node[1:d] AS node, sum(saved)::BIGINT AS saved, sum(leaf)::BIGINT AS leaves
    FROM own_share, unnest(range(0, len(node) + 1)) AS u(d) GROUP BY 1)
SELECT a.c AS conv_id, len(a.node)::BIGINT AS depth, p.c AS parent_conv_id, a.n_convs, coalesce(k.n, 0) AS n_children,
    u.leaves AS n_leaves, u.saved AS saved_tokens, sha256(a.ends) AS ends_sha256
FROM nodes a JOIN under u ON u.node = a.node LEFT JOIN children k ON k.node = a.node
LEFT JOIN nodes p ON len(a.node) > 0 AND p.node = a.node[1:len(a.node) - 1]
"""
