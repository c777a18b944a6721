"""Convergence, permutation, parsimony, selection proxies and pathway enrichment over tables of motifs."""

from __future__ import annotations

import random
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf
from pyspark.sql.types import Row, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn
from pyspark.sql.window import Window

from helixframe.functions.scores import phylogenetic_weight, r4
from helixframe.functions.sequence import AMINO_CLASS, let, letters, literal_map
from helixframe.functions.stats import benjamini_hochberg, log10_hypergeometric_tail, log_factorials
from helixframe.operators.relational import dealt_once, dedup_first, tasks_for

# Millions of years between lineages; other pairs take 100.
DIVERGENCE = {
    ("Bats", "Cetaceans"): 90, ("Bats", "Cnidarians"): 800, ("Bats", "Fishes"): 430, ("Bats", "Molluscs"): 700, ("Bats", "Proboscideans"): 90,
    ("Bats", "Reptiles"): 310, ("Bats", "Rodents"): 90, ("Bats", "Salamanders"): 360, ("Bats", "Sharks"): 450,
    ("Birds", "Cnidarians"): 800, ("Birds", "Fishes"): 430, ("Birds", "Molluscs"): 700, ("Birds", "Proboscideans"): 310, ("Birds", "Reptiles"): 280,
    ("Birds", "Salamanders"): 360, ("Birds", "Sharks"): 450,
    ("Cetaceans", "Cnidarians"): 800, ("Cetaceans", "Fishes"): 430, ("Cetaceans", "Molluscs"): 700, ("Cetaceans", "Proboscideans"): 90,
    ("Cetaceans", "Reptiles"): 310, ("Cetaceans", "Rodents"): 90, ("Cetaceans", "Salamanders"): 360, ("Cetaceans", "Sharks"): 450,
    ("Cnidarians", "Fishes"): 800, ("Cnidarians", "Molluscs"): 750, ("Cnidarians", "Proboscideans"): 800, ("Cnidarians", "Reptiles"): 800,
    ("Cnidarians", "Rodents"): 800, ("Cnidarians", "Salamanders"): 800, ("Cnidarians", "Sharks"): 750,
    ("Fishes", "Molluscs"): 700, ("Fishes", "Proboscideans"): 430, ("Fishes", "Reptiles"): 430, ("Fishes", "Rodents"): 430, ("Fishes", "Salamanders"): 380, ("Fishes", "Sharks"): 420,
    ("Molluscs", "Proboscideans"): 700, ("Molluscs", "Reptiles"): 700, ("Molluscs", "Rodents"): 700, ("Molluscs", "Salamanders"): 700, ("Molluscs", "Sharks"): 650,
    ("Primates", "Reptiles"): 310, ("Primates", "Rodents"): 90,
    ("Proboscideans", "Reptiles"): 310, ("Proboscideans", "Rodents"): 90, ("Proboscideans", "Salamanders"): 360, ("Proboscideans", "Sharks"): 450,
    ("Reptiles", "Rodents"): 310, ("Reptiles", "Salamanders"): 360, ("Reptiles", "Sharks"): 450,
    ("Rodents", "Salamanders"): 360, ("Rodents", "Sharks"): 450, ("Salamanders", "Sharks"): 450,
}
# Lineages of species, for convergence.
LINEAGES = {
    "african_elephant": "Proboscideans", "amazon_parrot": "Birds", "asian_elephant": "Proboscideans", "axolotl": "Salamanders", "beaver": "Rodents", "blind_mole_rat": "Rodents",
    "bowhead_whale": "Cetaceans", "brandts_bat": "Bats", "budgerigar": "Birds", "damaraland_mole_rat": "Rodents", "elephant": "Proboscideans", "elephant_shark": "Sharks",
    "greenland_shark": "Sharks", "ground_squirrel": "Rodents", "human": "Primates", "hydra": "Cnidarians", "little_brown_bat": "Bats", "little_skate": "Sharks", "macaque": "Primates",
    "mouse_lemur": "Primates", "naked_mole_rat": "Rodents", "nmr": "Rodents", "ocean_quahog_clam": "Molluscs", "painted_turtle": "Reptiles", "rat": "Rodents",
    "right_whale": "Cetaceans", "rougheye_rockfish": "Fishes", "sperm_whale": "Cetaceans", "spiny_mouse": "Rodents",
}


def distance_map(distances: dict[tuple[str, str], float] | None = None) -> Column:
    """Map of "a|b" to a distance, in both orders."""
    table = DIVERGENCE if distances is None else distances
    both = {f"{a}|{b}": float(d) for (a, b), d in table.items()} | {f"{b}|{a}": float(d) for (a, b), d in table.items()}
    return literal_map(both)


def lineage_count(lineages: Column) -> Column:
    """Distinct lineages but Primates and nulls."""
    return F.size(F.array_distinct(F.filter(lineages, lambda x: x.isNotNull() & (x != "Primates"))))


def convergence(motifs: DataFrame, distances: Column | None = None) -> DataFrame:
    """DS15: each gene's window with most lineages, the first of equals. motifs: (gene, start, species, lineage)."""
    windows = motifs.groupBy("gene", "start").agg(F.sort_array(F.collect_set("lineage")).alias("lineages"), F.sort_array(F.collect_set("species")).alias("species"))
    best = dedup_first(windows.withColumn("n", lineage_count(F.col("lineages"))), ["gene"], [F.col("n").desc(), F.col("start")])
    return best.withColumn("weight", phylogenetic_weight(F.col("lineages"), distance_map() if distances is None else distances))


def shuffled_labels(spark: SparkSession, lineages: dict[str, str], iterations: int, seed: int = 42) -> DataFrame:
    """(iteration, species, lineage): lineages dealt anew to the species, in the order of the given map."""
    rng, names, labels = random.Random(seed), list(lineages), list(lineages.values())
    rows = []
    for i in range(iterations):
        rng.shuffle(labels)
        rows += [(i, s, l) for s, l in zip(names, labels, strict=True)]
    return spark.createDataFrame(rows, "iteration int, species string, lineage string")


#: Parts that iterations are dealt to by their number. A task holds the labels of one, a byte each for up to 255 lineages.
PARTS = 8
#: Labels that are packed at a time, species in a row of packed labels, species of windows that are looked up at a time.
PACKED_LABELS, PACKED_SPECIES, LOOKED_UP = 2_000_000, 8192, 4096
_PACKED = "part int, names array<string>, iterations array<int>, lineages array<string>, codes binary"


def hashed_labels(species: DataFrame, iterations: int) -> DataFrame:
    """(iteration, species, lineage): the lineages, by their own species' names, dealt to the species by hashes of iteration and name.

    Species go to each block of iterations before they are multiplied, so labels are ordered where they are made and not shuffled.
    """
    blocks = max(1, min(16 * PARTS, iterations))  # the iterations of a block are in one part
    rows = species.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "species", "lineage")
    rows = dealt_once(rows, blocks, "block", by_number=True)
    own = rows.select("block", "lineage", F.row_number().over(Window.partitionBy("block").orderBy("species")).alias("r"))
    dealt = rows.select("block", "species", F.explode(F.sequence("block", F.lit(iterations - 1), F.lit(blocks))).alias("iteration"))
    order = F.md5(F.concat(F.col("iteration").cast("string"), "species"))
    dealt = dealt.withColumn("r", F.row_number().over(Window.partitionBy("iteration", "block").orderBy(order)))
    return dealt.join(own.hint("shuffle_hash"), ["block", "r"]).select("iteration", "species", "lineage")


def permutation_p(best: DataFrame, labels: DataFrame, most: int = PACKED_LABELS) -> DataFrame:
    """DS16: share of dealings in which a gene's best window has at least its own number of lineages.

    Labels are dealt rather than windows. They are packed to a byte each where they lie, `most` at a time, and meet the
    windows in tasks of a part of the iterations and a share of the genes. There a gene's dealings are counted in
    one array, so no row is made for each gene and iteration, and no label reaches the driver.
    """
    shares = max(1, -(-4 * best.sparkSession.sparkContext.defaultParallelism // PARTS))
    packed = labels.where(F.col("species").isNotNull()).select(F.col("iteration").cast("int").alias("iteration"), "species", "lineage").mapInArrow(lambda batches: _pack(batches, most), _PACKED)
    gene, n = (F.lit(None).cast(best.schema[c].dataType).alias(c) for c in ("gene", "n"))
    tables = packed.select("part", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"), gene, n, F.col("names").alias("species"), "iterations", "lineages", "codes")
    part, share, none = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"), F.pmod(F.xxhash64("gene"), F.lit(shares)).cast("int").alias("share"), F.array()
    # empty lists: of null ones Arrow's writer goes through the whole batch again at each row
    windows = best.select(part, share, "gene", "n", F.coalesce("species", none).alias("species"), none.cast("array<int>").alias("iterations"), none.cast("array<string>").alias("lineages"))
    both = tables.unionByName(windows, allowMissingColumns=True).withColumn("task", F.col("part") * shares + F.col("share")).drop("part", "share")
    met = both.repartitionById(PARTS * shares, "task").sortWithinPartitions(F.col("codes").isNull()).drop("task")  # labels come first
    counted = met.mapInArrow(_hits, best.select("gene", "n").schema.add("hits", "long").add("dealt", "long")).groupBy("gene", "n").agg(F.sum("hits").alias("hits"), F.sum("dealt").alias("dealt"))
    return counted.select("gene", F.when((F.col("n") < 1) | (F.col("dealt") == 0), 1.0).otherwise(r4(F.col("hits") / F.col("dealt"))).alias("p"))


def _pack(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Tables of species by iterations (_PACKED), their lineages by number: 0 is none, k the k-th of the row's."""
    held: list[pa.RecordBatch] = []

    def pack() -> Iterator[pa.RecordBatch]:
        labels = pa.Table.from_batches(held)
        held.clear()
        iteration = labels["iteration"].to_numpy()
        species, lineage = (labels[c].combine_chunks().dictionary_encode() for c in ("species", "lineage"))
        place, names, lineages = species.indices.to_numpy(), species.dictionary, lineage.dictionary.to_pylist()
        code = lineage.indices.fill_null(-1).to_numpy() + 1
        for part in np.unique(iteration % PARTS).tolist():
            own = iteration % PARTS == part
            iterations, column = np.unique(iteration[own], return_inverse=True)
            table = np.zeros((len(names), len(iterations)), np.uint8 if len(lineages) < 256 else np.uint32)
            table[place[own], column] = code[own]
            for i in range(0, len(names), PACKED_SPECIES):
                row = {"part": part, "names": names[i : i + PACKED_SPECIES].to_pylist(), "iterations": iterations.tolist(), "lineages": lineages, "codes": table[i : i + PACKED_SPECIES].tobytes()}
                yield pa.RecordBatch.from_pylist([row], _PACKED_ARROW)

    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= most:
            yield from pack()
    if held:
        yield from pack()


_PACKED_ARROW = pa.schema([("part", pa.int32()), ("names", pa.list_(pa.string())), ("iterations", pa.list_(pa.int32())), ("lineages", pa.list_(pa.string())), ("codes", pa.binary())])


def _table(packed: pa.Table) -> tuple[np.ndarray, pa.Array, int, int]:
    """One table of rows of _PACKED: codes of lineages by species and iteration; the species, how many iterations and lineages there are."""
    names, lists, kinds = packed["species"].combine_chunks(), packed["iterations"].to_pylist(), packed["lineages"].to_pylist()
    places, ends = names.flatten().dictionary_encode(), np.cumsum(names.value_lengths().to_numpy())
    columns = {x: k for k, x in enumerate(dict.fromkeys(x for r in lists for x in r))}
    codes = {x: k for k, x in enumerate(dict.fromkeys(x for r in kinds for x in r if x != "Primates"), 1)}
    # row 0 is of no species, 0 counts as no lineage; eight dealings are read as one word
    table = np.zeros((len(places.dictionary) + 1, -(-len(columns) // 8) * 8), np.uint8 if len(codes) < 256 else np.uint32)
    for place, iterations, lineages, own in zip(np.split(places.indices.to_numpy() + 1, ends[:-1]), lists, kinds, packed["codes"], strict=True):
        found = np.frombuffer(own.as_buffer(), np.uint8 if len(lineages) < 256 else np.uint32).reshape(len(place), len(iterations))
        at = np.ix_(place, [columns[x] for x in iterations])
        # species and iterations may come in several rows, which leave each other's cells at 0
        table[at] = np.maximum(table[at], np.array([0, *(codes.get(x, 0) for x in lineages)], table.dtype).take(found))
    return table, places.dictionary, len(columns), len(codes)


def _hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gene, n, hits, dealt) of windows over the dealings of the packed labels before them."""
    packed: list[pa.RecordBatch] = []
    table = None
    for b in batches:
        if table is None and b.column("codes").null_count < b.num_rows:
            packed.append(b.filter(b.column("codes").is_valid()).select(["species", "iterations", "lineages", "codes"]))
            b = b.filter(b.column("codes").is_null())
        if not b.num_rows:
            continue
        if table is None:
            table, names, dealt, kinds = _table(pa.Table.from_batches(packed)) if packed else (np.zeros((1, 0), np.uint8), pa.array([], pa.string()), 0, 0)
            packed.clear()
            # lineages are bits of bytes; a window's are those of its species together
            bits = np.zeros((-(-kinds // 8), kinds + 1), np.uint8)
            for k in range(kinds):
                bits[k // 8, k + 1] = 1 << (k % 8)
        species = b.column("species")
        ends = np.cumsum(species.value_lengths().to_numpy().astype(np.int64) + 1)  # each window begins with no species
        starts = np.concatenate([[0], ends[:-1]])
        at, named = np.zeros(ends[-1], np.int64), np.ones(ends[-1], bool)
        named[starts] = False
        at[named] = pc.index_in(species.flatten(), value_set=names).fill_null(-1).to_numpy().astype(np.int64) + 1
        least, hits, i = b.column("n").to_numpy(zero_copy_only=False), np.zeros(len(starts), np.int64), 0
        while i < len(starts) and kinds:
            until = max(i + 1, int(np.searchsorted(ends, starts[i] + LOOKED_UP, "right")))
            found, first = table.take(at[starts[i] : ends[until - 1]], axis=0), starts[i:until] - starts[i]
            lineages = sum(np.bitwise_count(np.bitwise_or.reduceat(w.take(found).view(np.uint64), first, axis=0).view(np.uint8)).astype(np.uint8 if kinds < 256 else np.int32) for w in bits)
            hits[i:until] = (lineages[:, :dealt] >= least[i:until, None]).sum(axis=1)
            i = until
        yield pa.RecordBatch.from_arrays([b.column("gene"), b.column("n"), pa.array(hits), pa.array(np.full(len(hits), dealt, np.int64))], names=["gene", "n", "hits", "dealt"])


# --- parsimony ---------------------------------------------------------------------------------


def parse_newick(text: str) -> list[tuple[str, int]]:
    """Nodes as (name, parent) in preorder, the root's parent -1. Branch lengths are dropped."""
    nodes: list[tuple[str, int]] = [("", -1)]
    at, name = 0, ""
    skip = False
    for c in text.strip().rstrip(";"):
        if c in "(,)":
            nodes[at] = (name.strip(), nodes[at][1])
            name, skip = "", False
            if c == "(":
                nodes.append(("", at))
                at = len(nodes) - 1
            elif c == ",":
                nodes.append(("", nodes[at][1]))
                at = len(nodes) - 1
            else:
                at = nodes[at][1]
                name = nodes[at][0]
        elif c == ":":
            skip = True
        elif not skip:
            name += c
    nodes[at] = (name.strip(), nodes[at][1])
    return nodes


def state_bit(residue: Column) -> Column:
    """A residue as one bit of a long, in the order of the characters; a gap as none."""
    return F.when(residue == "-", F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.ascii(residue) - 32, F.lit(64)).cast("int")))


def bit_state(bit: Column) -> Column:
    return F.when(bit == 0, "-").otherwise(F.char((F.bit_count(bit - 1) + 32).cast("int")))


def fitch_parents(states: Column, tree: list[tuple[str, int]]) -> Column:
    """DS17: array of (species, parent): the parsimonious state of each leaf's parent, as bits; empty below three known leaves.

    states: map of species to state_bit(). Sets of states are bits of longs. One pass over the nodes from the leaves up
    gives each node the intersection of its children's sets, or their union where that is empty; one from the root down
    takes the parent's state if the set has it, else the first. Children without known leaves don't count, and a node with one
    child that does is passed through, as if it were pruned.
    """
    children: dict[int, list[int]] = {}
    for i, (_, parent) in enumerate(tree):
        children.setdefault(parent, []).append(i)
    up = list(reversed(range(len(tree))))  # children before their parents
    place = {node: k for k, node in enumerate(up)}
    long = lambda x: F.lit(x).cast("long")
    nodes = F.array(*[F.struct(F.lit(tree[i][0] if i not in children else None).cast("string").alias("leaf"), F.array(*[F.lit(place[c]) for c in children.get(i, [])]).cast("array<int>").alias("below")) for i in up])
    entry = "array<struct<leaves:int,live:int,states:bigint>>"

    def climb(done: Column, node: Column) -> Column:
        known = F.map_contains_key(states, F.coalesce(node["leaf"], F.lit("")))
        own = F.struct(known.cast("int").alias("leaves"), F.lit(0).alias("live"), F.coalesce(F.try_element_at(states, F.coalesce(node["leaf"], F.lit(""))), long(0)).alias("states"))
        below = F.filter(F.transform(node["below"], lambda c: F.get(done, c)), lambda x: x["leaves"] > 0)
        sets = F.filter(F.transform(below, lambda x: x["states"]), lambda x: x != 0)
        both, any_ = F.aggregate(sets, long(-1), lambda x, y: x.bitwiseAND(y)), F.aggregate(sets, long(0), lambda x, y: x.bitwiseOR(y))
        found = F.when((any_ != 0) & (both != 0), both).otherwise(any_)
        inner = F.struct(F.aggregate(below, F.lit(0), lambda n, x: n + x["leaves"]).alias("leaves"), F.size(below).alias("live"), found.alias("states"))
        return F.concat(done, F.array(F.when(node["leaf"].isNull(), inner).otherwise(own)))

    # from the root down, places run backwards; a node's parent comes before it
    down = [(len(tree) - 1 - place[i], i) for i in range(len(tree))]
    order = F.array(*[F.struct(F.lit(place[i]).alias("at"), F.lit(place[tree[i][1]] if tree[i][1] >= 0 else -1).alias("above")) for _, i in sorted(down)])

    def descend(sets: Column):
        def step(chosen: Column, node: Column) -> Column:
            above = F.coalesce(F.when(node["above"] >= 0, F.get(chosen, F.lit(len(tree) - 1) - node["above"])), long(0))
            own = F.get(sets, node["at"])
            first = own["states"].bitwiseAND(-own["states"])
            kept = (own["live"] == 1) | (above.bitwiseAND(own["states"]) != 0) | (own["states"] == 0)
            return F.concat(chosen, F.array(F.when(kept, above).otherwise(first)))

        return F.aggregate(order, F.array().cast("array<bigint>"), step)

    leaves = F.array(*[F.struct(F.lit(tree[i][0]).alias("species"), F.lit(len(tree) - 1 - place[tree[i][1]]).alias("above")) for i in range(len(tree)) if i not in children and tree[i][1] >= 0]).cast("array<struct<species:string,above:int>>")
    parents = lambda chosen: F.transform(F.filter(leaves, lambda x: F.map_contains_key(states, x["species"])), lambda x: F.struct(x["species"].alias("species"), F.get(chosen, x["above"]).alias("parent")))
    sets = F.aggregate(nodes, F.array().cast(entry), climb)
    return let(sets, lambda s: F.when(F.get(s, F.lit(len(tree) - 1))["leaves"] >= 3, let(descend(s), parents)).otherwise(F.array().cast("array<struct<species:string,parent:bigint>>")))


#: Nodes of a tree whose states are columns; the states of larger ones are arrays.
COLUMN_NODES = 64


def fitch_columns(residues: DataFrame, tree: list[tuple[str, int]]) -> DataFrame:
    """DS17: (gene, pos, c0, c1, ...), each node's parsimonious state as fitch_parents() has it, of positions with three known leaves, and the leaves' own sets s0, s1, ... residues: (gene, pos, species, a)."""
    children: dict[int, list[int]] = {}
    for i, (_, parent) in enumerate(tree):
        children.setdefault(parent, []).append(i)
    long = F.lit(0).cast("long")
    leaves = [i for i in range(len(tree)) if i not in children]
    first = {i: F.min(F.when(F.col("species") == tree[i][0], F.ascii("a"))) for i in leaves}  # of several residues the first letter
    rows = residues.groupBy("gene", "pos").agg(*[code.alias(f"s{i}") for i, code in first.items()])
    bit = lambda code: F.coalesce(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(code - 32, F.lit(64)).cast("int")), long)
    known = reduce(lambda x, y: x + y, [F.col(f"s{i}").isNotNull().cast("int") for i in leaves])
    rows = rows.where(known >= 3).select("gene", "pos", *[bit(F.col(f"s{i}")).alias(f"s{i}") for i in leaves])
    for i in reversed(range(len(tree))):
        if i in children:
            sets = [F.col(f"s{c}") for c in children[i]]
            both = reduce(lambda x, y: x.bitwiseAND(y), [F.when(s != 0, s).otherwise(F.lit(-1).cast("long")) for s in sets])
            any_ = reduce(lambda x, y: x.bitwiseOR(y), sets)
            rows = rows.withColumns({f"b{i}": both, f"a{i}": any_})
            rows = rows.withColumn(f"s{i}", F.when((F.col(f"a{i}") != 0) & (F.col(f"b{i}") != 0), F.col(f"b{i}")).otherwise(F.col(f"a{i}"))).drop(f"a{i}", f"b{i}")
    for i, (_, parent) in enumerate(tree):
        if i in children:
            own, above = F.col(f"s{i}"), F.col(f"c{parent}") if parent >= 0 else long
            alone = reduce(lambda x, y: x + y, [(F.col(f"s{c}") != 0).cast("int") for c in children[i]]) == 1
            rows = rows.withColumn(f"c{i}", F.when(alone | (above.bitwiseAND(own) != 0) | (own == 0), above).otherwise(own.bitwiseAND(-own)))
    return rows.select("gene", "pos", *[f"s{i}" for i in leaves], *[f"c{i}" for i in range(len(tree)) if i in children])


def convergent_positions(motifs: DataFrame, newick: str | None = None, skip: tuple[str, ...] = ("Primates", "Other"), size: int | None = None) -> DataFrame:
    """DS18: (motif, convergent_aa): the most lineages that share a class of substituted residue at one of its positions.

    motifs: (motif, gene, start, human, animal, species, lineage). With a tree, only residues that differ
    from the parsimonious state of the parent count; each position goes through Fitch's algorithm by itself, and of
    several residues of a species there the first letter is its state. Motifs are dealt to tasks by their gene, so their
    residues are never shuffled; size: how many motifs there are, where that is known without counting.
    """
    motifs = dealt_once(motifs, tasks_for(motifs, motifs.count() if size is None else size), "gene")
    at = F.posexplode(F.arrays_zip(letters(F.col("human")).alias("h"), letters(F.col("animal")).alias("a")))
    residues = motifs.select("motif", "gene", "start", "species", F.coalesce("lineage", F.lit("Other")).alias("lineage"), at.alias("i", "pair"))
    residues = residues.select("motif", "gene", "species", "lineage", (F.col("start") + F.col("i")).alias("pos"), F.col("pair.h").alias("h"), F.upper("pair.a").alias("a"))
    usable = (F.col("h") != "-") & (F.col("a") != "-") & (F.col("h") != F.col("a")) & ~F.col("lineage").isin(*skip) & (F.col("species") != "human")
    changed = residues.where(F.coalesce(usable, F.lit(False))).withColumn("klass", F.coalesce(F.try_element_at(literal_map(AMINO_CLASS), F.col("a")), F.lit(-1)))
    # of several residues of a lineage at a position, the first species' counts
    firsts = lambda rows: dedup_first(rows, ["gene", "pos", "lineage"], [F.col("species"), F.col("motif")])
    tree = parse_newick(newick) if newick else []
    if tree and len(tree) <= COLUMN_NODES:
        inner = {p for _, p in tree}
        leaves = [(i, name, p) for i, (name, p) in enumerate(tree) if i not in inner and p >= 0]
        parent = F.coalesce(F.lit(None).cast("long"), *[F.when(F.col("species") == name, F.col(f"c{p}")) for _, name, p in leaves])
        changed = changed.join(fitch_columns(changed, tree).hint("shuffle_hash"), ["gene", "pos"]).where(parent != state_bit(F.col("a"))).select(*changed.columns)
    elif tree:
        states = changed.groupBy("gene", "pos", "species").agg(F.min("a").alias("a")).groupBy("gene", "pos").agg(F.map_from_entries(F.collect_list(F.struct("species", state_bit(F.col("a"))))).alias("states"))
        parents = states.select("gene", "pos", F.explode(fitch_parents(F.col("states"), tree)).alias("p")).select("gene", "pos", "p.species", "p.parent")
        changed = changed.join(parents, ["gene", "pos", "species"]).where(F.col("parent") != state_bit(F.col("a")))
    kinds = firsts(changed).groupBy("gene", "pos", "klass").agg(F.count("*").alias("n"))
    totals = kinds.groupBy("gene", "pos").agg(F.sum("n").alias("lineages"), F.max(F.when(F.col("klass") >= 0, F.col("n"))).alias("most")).where("lineages >= 2")
    best = residues.select("motif", "gene", "pos").join(totals.hint("shuffle_hash"), ["gene", "pos"]).select("motif", "most")
    every = best.unionByName(motifs.select("motif", F.lit(None).cast("long").alias("most")))  # also motifs without residues
    return every.groupBy("motif").agg(F.coalesce(F.max("most"), F.lit(0)).cast("long").alias("convergent_aa"))


def divergence_proxy(pairs: DataFrame) -> DataFrame:
    """DS19: (og, omega, p) from the mean divergence of aligned pairs (og, a, b) over columns without a gap."""
    zipped = F.filter(F.arrays_zip(letters(F.col("a")).alias("a"), letters(F.col("b")).alias("b")), lambda p: (p["a"] != "-") & (p["b"] != "-"))
    d = F.when(F.size(zipped) > 0, F.size(F.filter(zipped, lambda p: p["a"] != p["b"])) / F.size(zipped))
    mean = pairs.select("og", d.alias("d")).groupBy("og").agg(F.avg("d").alias("d"))
    return mean.select("og", (F.col("d") / 0.15).alias("omega"), F.greatest(F.lit(0.001), 1 - F.least(F.col("d") / 0.30, F.lit(1.0))).alias("p"))


# Ranks of models where an orthogroup has several results, and states without a result.
MODEL_RANK = {"paml_branch_site": 3, "paml_no_signal": 1, "proxy": 0}
NO_RESULT = ("no_codon_alignment", "meme_failed", "skipped", "not_in_aligned")
SELECTION_RESULT = "og string, status string, selection_model string, dnds_ratio double, dnds_pvalue double"


def write_selection(results: DataFrame, path: str, batches: int) -> None:
    """AN28: results (SELECTION_RESULT) as JSON lines with the name og_id, a folder for each batch of orthogroups."""
    results.withColumnRenamed("og", "og_id").withColumn("batch", F.pmod(F.xxhash64("og_id"), F.lit(batches))).write.partitionBy("batch").json(path)


def read_selection(spark: SparkSession, path: str) -> DataFrame:
    """AN28: (og, selection_model, dnds_ratio, dnds_pvalue) of all batches: each orthogroup's result of the highest model, then the smallest p.

    A result names its orthogroup as og_id or og; else the folder of its file is the name. A line that isn't JSON is left out.
    """
    raw = spark.read.schema(f"og_id string, {SELECTION_RESULT}, broken string").option("columnNameOfCorruptRecord", "broken").json(path, recursiveFileLookup=True)
    folder = F.regexp_extract(F.input_file_name(), "([^/]+)/[^/]+$", 1)
    named = raw.withColumn("og", F.coalesce(F.nullif("og_id", F.lit("")), F.nullif("og", F.lit("")), folder)).where("broken IS NULL").drop("og_id", "broken")
    rows = named.where(~F.coalesce("status", F.lit("")).isin(*NO_RESULT))
    rank = F.coalesce(F.try_element_at(literal_map(MODEL_RANK), F.col("selection_model")), F.lit(0))
    return dedup_first(rows, ["og"], [rank.desc(), F.col("selection_model"), F.col("dnds_pvalue"), F.col("dnds_ratio")]).drop("status")


@udtf
class OrthogroupProxy:
    """UDF3: the worker of one orthogroup as a table function: orthogroup_proxy(TABLE(aligned) PARTITION BY og).

    It takes the rows (og, label, seq) of a group, as many as there are species, and gives (og, sequences, omega, p).
    """

    @staticmethod
    def analyze(rows: AnalyzeArgument) -> AnalyzeResult:
        if not rows.isTable or not {"og", "label", "seq"} <= {f.name for f in rows.dataType.fields}:
            raise ValueError("a table with og, label and seq is expected")
        schema = StructType().add("og", "string").add("sequences", "long").add("omega", "double").add("p", "double")
        return AnalyzeResult(schema, partitionBy=[PartitioningColumn("og")], orderBy=[OrderingColumn("label")])

    def __init__(self):
        self.rows: list[tuple[str, str, str]] = []

    def eval(self, row: Row) -> None:
        self.rows.append((row["og"], row["label"], row["seq"]))

    def terminate(self) -> Iterator[tuple]:
        human = next((seq for _, label, seq in self.rows if "human" in label.lower()), None)
        shares = []
        for _, label, seq in self.rows:
            if human is not None and "human" not in label.lower():
                pairs = [(a, b) for a, b in zip(human, seq, strict=False) if a != "-" and b != "-"]
                if pairs:
                    shares.append(sum(a != b for a, b in pairs) / len(pairs))
        if shares:
            d = sum(shares) / len(shares)
            yield self.rows[0][0], len(self.rows), d / 0.15, max(0.001, 1 - min(d / 0.30, 1.0))


def register_functions(spark: SparkSession) -> None:
    """UDF3: make the table functions known to SQL."""
    spark.udtf.register("orthogroup_proxy", OrthogroupProxy)


def named_pathways(pathways: DataFrame, names: DataFrame, sizes: DataFrame, fallback: int = 50) -> DataFrame:
    """SC13: pathways with pathway_name, the id where none is known, and gene_count, the fallback where none or nought is known. names: (pathway_id, name); sizes: (pathway_id, size)."""
    joined = pathways.join(names, "pathway_id", "left").join(sizes, "pathway_id", "left")
    return joined.select(*pathways.columns, F.coalesce(F.nullif("name", F.lit("")), F.col("pathway_id")).alias("pathway_name"), F.coalesce(F.nullif("size", F.lit(0)), F.lit(fallback)).cast("int").alias("gene_count"))


def pathway_enrichment(genes: DataFrame, background: int = 20000, fallback: int = 50, least: int = 2) -> DataFrame:
    """DS26, SC3: (pathway, genes, log_p, score, q). genes: (gene, pathways, convergence, is_candidate); pathway sizes are their gene counts in the table, or the fallback.

    The number of candidates bounds the log-factorial table together with the background.
    """
    drawn = genes.agg(F.count_if(F.col("is_candidate")).alias("drawn"))
    rows = genes.select("gene", "convergence", "is_candidate", F.explode(F.array_distinct("pathways")).alias("pathway"))
    best = rows.groupBy("pathway", "gene").agg(F.max("convergence").alias("c"), F.max("is_candidate").alias("hit"))
    sums = best.groupBy("pathway").agg(F.count("*").alias("size"), F.count_if("hit").alias("genes"), F.sum(F.when(F.col("hit"), F.col("c"))).alias("total")).where(F.col("genes") >= least)
    joined = sums.crossJoin(F.broadcast(drawn)).crossJoin(F.broadcast(log_factorials(genes.sparkSession, background)))
    log_p = log10_hypergeometric_tail(F.col("genes"), F.coalesce(F.nullif("size", F.lit(0)), F.lit(fallback)), F.col("drawn"), F.lit(background), F.col("lf"))
    scored = joined.select("pathway", "genes", log_p.alias("log_p"), "total").withColumn("score", r4(-F.col("log_p") / 2 + F.col("total") / 2)).withColumn("p", F.pow(F.lit(10.0), F.col("log_p")))
    return benjamini_hochberg(scored, "p", "q").select("pathway", "genes", "log_p", "score", "q")


def meme_branches(results: DataFrame, test_species: Column) -> DataFrame:
    """DS20: test species whose branch has omega above 1. results: (og, omegas map<species, double>)."""
    chosen = F.array_intersect(F.map_keys(F.map_filter("omegas", lambda _, w: w > 1)), test_species)
    return results.select("og", F.sort_array(chosen).alias("branches"))
