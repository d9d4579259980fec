"""Hierarchical Pitman-Yor language model: a restaurant for every preceding word over one shared parent, seated by Gibbs sampling.

The counts of neighbouring words form a matrix (word before, word) that is cut into square cells.
A cell meets only the figures of its own words, so no task holds all contexts of a frequent word.
"""

import math

import numpy as np
import pyarrow as pa
import pyspark
import zstandard
from pyspark.sql import functions as F

from tallychain.llm.ranks import numbered
from tallychain.llm.texts import settled

#: Tokens of a block: the unit in which texts are kept as word numbers.
BLOCK_TOKENS = 2_000_000
#: Tokens of the corpus for each cell of the matrix; a cell has at most 1 << ``SIDE_BITS`` words a side.
CELL_TOKENS, SIDE_BITS = 2_000_000, 20
#: Gibbs sweeps over the corpus, and over how many of the last ones probabilities are averaged.
SWEEPS, KEPT = 6, 3
STRENGTH = 1.0
#: Customers that are seated one by one; later ones sit down in steps of a quarter of those before.
SINGLY = 32

_END = b""
_STEPS = float(1 << 32)
_BLOCK = "block long, size long, doc_ids array<bigint>, train array<boolean>, lengths array<int>, tokens binary"
_SUMS = "side int, segment long, a binary, b binary, one long, two long, total_a double, total_b double"


def held_out(doc_id, folds=7, fold=2):
    """Rows that don't teach: the checksum of the id as text leaves ``fold`` when divided by ``folds``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def _packed(values):
    """Bytes of an array, those of equal weight side by side, compressed."""
    return zstandard.compress(np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T.tobytes(), 1)


def _opened(data, kind):
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), dtype=np.uint8).reshape(size, -1).T).view(kind).ravel()


def _packed_keys(keys):
    return _packed(np.diff(keys, prepend=0))


def _opened_keys(data):
    return np.cumsum(_opened(data, "<i8"))


def _packed_logs(logs):
    """Logarithms in steps of 2 ** -32, which is closer than 2e-10, in fewer bytes than doubles take."""
    return _packed(np.rint(logs * -_STEPS).astype("<i8"))


def _opened_logs(data):
    return _opened(data, "<i8") / -_STEPS


def _blocks(docs):
    """Texts as word numbers, by block: a block has its own list of words, in which the empty one is the end of a text."""

    def run(batches):
        part = pyspark.TaskContext.get().partitionId()
        made = 0
        state = None

        def close():
            numbers = np.concatenate(state["tokens"])
            lengths = np.array([len(t) for t in state["tokens"]], dtype=np.int32)
            words = pa.array(list(state["known"]), type=pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + made]), pa.array([len(numbers)]), pa.array([state["ids"]], type=pa.list_(pa.int64())), pa.array([state["train"]]),
                 pa.array([lengths]), pa.array([_packed(numbers)], type=pa.binary()),
                 pa.ListArray.from_arrays(pa.array([0, len(words)], type=pa.int32()), words)],
                names=["block", "size", "doc_ids", "train", "lengths", "tokens", "words"],
            )

        for batch in batches:
            for doc_id, teaches, text in zip(batch.column("doc_id").to_pylist(), batch.column("train").to_pylist(), batch.column("text")):
                if state is None:
                    known = _Numbers()
                    state, held = {"ids": [], "train": [], "tokens": [], "known": known}, 0
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").lower().split()
                words.append(_END)
                state["tokens"].append(np.fromiter(map(known.__getitem__, words), dtype=np.int32, count=len(words)))
                state["ids"].append(doc_id)
                state["train"].append(teaches)
                held += len(words)
                if held >= BLOCK_TOKENS:
                    yield close()
                    state, made = None, made + 1
        if state is not None:
            yield close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (~held_out(F.col("doc_id"))).alias("train"), "text")
    return rows.mapInArrow(run, f"{_BLOCK}, words array<string>")


class _Numbers(dict):
    """Gives each new key the next number."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def _teaching(train, lengths):
    """Which tokens of a block are in texts that teach."""
    return np.repeat(train.values.to_numpy(zero_copy_only=False), lengths.values.to_numpy())


def _listed(blocks):
    """(block, key, word, n): the words of each block, their number in it, and how often its training texts have them."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                words = batch.column("words")[i].values
                tokens = _opened(batch.column("tokens")[i].as_py(), "<i4")
                n = np.bincount(tokens[_teaching(batch.column("train")[i], batch.column("lengths")[i])], minlength=len(words))
                for at in range(0, len(words), 50_000):
                    some = words.slice(at, 50_000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(some), batch.column("block")[i].as_py())), pa.array(np.arange(at, at + len(some))), some, pa.array(n[at:at + len(some)])],
                        names=["block", "key", "word", "n"],
                    )

    return blocks.select("block", "train", "lengths", "tokens", "words").mapInArrow(run, "block long, key long, word string, n long")


def _numbers_of(listed):
    """(block, numbers, counts): for the words of each block, in the order of their numbers in it, those of the whole corpus and their counts there."""

    def run(words):
        order = np.argsort(words["key"].to_numpy())
        packed = {name: pa.array([_packed(words[column].to_numpy()[order].astype(np.int64))], type=pa.binary()) for name, column in (("numbers", "place"), ("counts", "c"))}
        return pa.table({"block": pa.array([words["block"][0].as_py()]), **packed})

    return listed.groupBy("block").applyInArrow(run, "block long, numbers binary, counts binary")


class _Grid:
    """Cells of the matrix: ``across`` segments a side with ``side`` words each."""

    def __init__(self, tokens, words):
        most = int(math.sqrt(1 << 63 - 2 * SIDE_BITS)) - 1  # so that a code has 63 bits
        self.across = max(1, min(most, math.ceil(math.sqrt(tokens / CELL_TOKENS))), math.ceil(words / (1 << SIDE_BITS)))
        self.side = max(1, math.ceil(words / self.across))

    def codes(self, tokens, numbers):
        """Of each token: its cell, and in the lower bits the places in it of the word before and of the token.

        The end stands before the first token of a text: every text ends with it, the last one of the block too.
        """
        segment, place = np.divmod(numbers, self.side)
        before, after = (segment * self.across << 2 * SIDE_BITS) + (place << SIDE_BITS), (segment << 2 * SIDE_BITS) + place
        return before[np.roll(tokens, 1)] + after[tokens]


def _local(codes):
    return codes & (1 << 2 * SIDE_BITS) - 1


def _places(keys):
    """Places in the cell of the words before and of the words."""
    return keys >> SIDE_BITS, keys & (1 << SIDE_BITS) - 1


def _pieces(codes):
    """(cell, first, end) of sorted codes."""
    cells = codes >> 2 * SIDE_BITS
    starts = np.nonzero(np.diff(cells, prepend=-1))[0]
    return zip(cells[starts], starts, np.append(starts[1:], len(codes)))


def _asked(blocks, grid):
    """(cell, block, keys, n): the pairs of each block by cell, in order, and how often its training texts have them."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                codes = grid.codes(_opened(batch.column("tokens")[i].as_py(), "<i4"), _opened(batch.column("numbers")[i].as_py(), "<i8"))
                found, place = np.unique(codes, return_inverse=True)
                n = np.bincount(place[_teaching(batch.column("train")[i], batch.column("lengths")[i])], minlength=len(found))
                del codes, place
                rows = [(cell, _packed_keys(_local(found[a:b])), _packed(n[a:b].astype("<i4"))) for cell, a, b in _pieces(found)]
                for at in range(0, len(rows), 1000):
                    cell, keys, counts = zip(*rows[at:at + 1000])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.array(cell, dtype=np.int64)), pa.array(np.full(len(cell), batch.column("block")[i].as_py())),
                         pa.array(keys, type=pa.binary()), pa.array(counts, type=pa.binary())],
                        names=["cell", "block", "keys", "n"],
                    )

    return blocks.select("block", "train", "lengths", "tokens", "numbers").mapInArrow(run, "cell long, block long, keys binary, n binary")


def _cells(asked, grid):
    """(cell, i, j, keys, n): the pairs of training texts by cell; cells that only other texts ask for are there without any."""
    across = grid.across

    def run(rows):
        keys = np.concatenate([_opened_keys(k.as_py()) for k in rows["keys"]])
        found, place = np.unique(keys, return_inverse=True)
        n = np.zeros(len(found), dtype=np.int64)
        np.add.at(n, place, np.concatenate([_opened(k.as_py(), "<i4") for k in rows["n"]]))
        cell = rows["cell"][0].as_py()
        return pa.table({
            "cell": [cell], "i": [cell // across], "j": [cell % across],
            "keys": pa.array([_packed_keys(found[n > 0])], type=pa.binary()), "n": pa.array([_packed(n[n > 0])], type=pa.binary()),
        })

    return asked.groupBy("cell").applyInArrow(run, "cell long, i long, j long, keys binary, n binary")


def _uniform(seeds, salt):
    """Numbers in (0, 1) from 64-bit seeds and a salt, the same in every run (the mixing steps of splitmix64)."""
    mix = (0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF
    with np.errstate(over="ignore"):
        z = seeds + np.uint64(mix)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = z ^ (z >> np.uint64(31))
    return ((z >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def _seeds(before, word=0):
    with np.errstate(over="ignore"):
        return before.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D) + np.asarray(word).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def seat(customers, weight, discount, seeds, salt):
    """Tables that ``customers`` of one dish take, seated one after another: a new table against weight : customers - discount * tables.

    After ``SINGLY`` customers they come in groups of a quarter of those seated, which take their
    expected number of new tables, rounded at random.  That is an approximation; the README has its
    measured error.
    """
    tables = np.minimum(customers, 1).astype(np.float64)
    active = np.nonzero(customers > 1)[0]
    seated, step = 1, 0
    while len(active):
        group = 1 if seated < SINGLY else seated // 4
        now = np.minimum(group, customers[active] - seated)
        w, t = weight[active], tables[active]
        chance = w / (w + seated - discount * t)
        tables[active] = np.minimum(t + np.floor(now * chance + _uniform(seeds[active], salt * 1009 + step)), seated + now)
        seated, step = seated + group, step + 1
        active = active[customers[active] > seated]
    return tables


class _World:
    """What all restaurants share: discounts, and customers and tables of the parent in one state."""

    def __init__(self, discount, root_discount, words, customers, tables):
        self.discount, self.root_discount, self.words, self.customers, self.tables = discount, root_discount, words, customers, tables

    @property
    def fresh(self):
        """Weight of one symbol's share in a new table of the parent."""
        return (STRENGTH + self.root_discount * self.tables) / (self.words + 1)

    def parent(self, sent, tables):
        return (sent - self.root_discount * tables + self.fresh) / (STRENGTH + self.customers)

    def tables_of(self, grid, i, j, keys, n, opened, parent, salt):
        """Tables of each pair of a cell, drawn anew; the same state and salt give the same draw."""
        before, word = _places(keys)
        weight = (STRENGTH + self.discount * opened[before]) * parent[word]
        return seat(n, weight, self.discount, _seeds(before + i * grid.side, word + j * grid.side), salt)


def _summed(cells, grid, draw, root):
    """Sums by segment: of a word as context its customers and tables (side 0), of a word as dish its tables everywhere and in the parent (side 1)."""
    side = grid.side

    def parts(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys, n = _opened_keys(row["keys"]), _opened(row["n"], "<i8")
                tables = draw(row, keys, n)
                before, word = _places(keys)
                sums = [np.bincount(x, weights=y, minlength=side) for x, y in ((before, n), (before, tables), (word, tables))]
                yield pa.RecordBatch.from_pydict({
                    "side": pa.array([0, 1], type=pa.int32()), "segment": [row["i"], row["j"]],
                    "a": pa.array([_packed(sums[0]), _packed(sums[2])], type=pa.binary()), "b": pa.array([_packed(sums[1]), b""], type=pa.binary()),
                    "one": [int((n == 1).sum()), 0], "two": [int((n == 2).sum()), 0],
                })

    def gather(rows):
        kind, segment = rows["side"][0].as_py(), rows["segment"][0].as_py()
        a, b = np.zeros(side), np.zeros(side)
        for x, y in zip(rows["a"], rows["b"]):  # one piece is unpacked at a time
            a += _opened(x.as_py(), "<f8")
            if kind == 0:
                b += _opened(y.as_py(), "<f8")
        one, two = sum(rows["one"].to_pylist()), sum(rows["two"].to_pylist())
        if kind == 1:
            b, one, two = root(a, segment), int((a == 1).sum()), int((a == 2).sum())
        return pa.table({
            "side": pa.array([kind], type=pa.int32()), "segment": [segment], "a": pa.array([_packed(a)], type=pa.binary()), "b": pa.array([_packed(b)], type=pa.binary()),
            "one": [one], "two": [two], "total_a": [float(a.sum())], "total_b": [float(b.sum())],
        })

    some = cells.mapInArrow(parts, "side int, segment long, a binary, b binary, one long, two long")
    return some.groupBy("side", "segment").applyInArrow(gather, _SUMS)


def _beside(cells, state, grid):
    """Cells with the sums of their own words: ``ua`` and ``ub`` of the words before, ``wa`` and ``wb`` of the words; lists are taken over as they are.

    Every segment goes to each cell of its row or column, so that all cells are dealt, not rows of cells.
    """
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(grid.across - 1).cast("long"))).alias("other")
    dealt = state.select("side", "segment", "a", "b", other)
    across = F.lit(grid.across)
    before = dealt.where("side = 0").select((F.col("segment") * across + F.col("other")).alias("cell"), F.col("a").alias("ua"), F.col("b").alias("ub"))
    word = dealt.where("side = 1").select((F.col("other") * across + F.col("segment")).alias("cell"), F.col("a").alias("wa"), F.col("b").alias("wb"))
    return cells.join(before, "cell").join(word, "cell")


def _discount(once, twice):
    return min(0.95, max(0.05, once / max(1, once + 2 * twice)))


def _totals(state):
    """Per side: the sums over all segments."""
    rows = state.groupBy("side").agg(*(F.sum(k).alias(k) for k in ("one", "two", "total_a", "total_b"))).collect()  # two rows
    none = {"one": 0, "two": 0, "total_a": 0.0, "total_b": 0.0}
    return [next((r.asDict() for r in rows if r.side == k), none) for k in (0, 1)]


def _draw(grid, world, salt):
    def draw(row, keys, n):
        parent = world.parent(_opened(row["wa"], "<f8"), _opened(row["wb"], "<f8"))
        return world.tables_of(grid, row["i"], row["j"], keys, n, _opened(row["ub"], "<f8"), parent, salt)

    return draw


def _draw_root(grid, world, salt):
    def root(sent, segment):
        seeds = _seeds(np.arange(grid.side) + segment * grid.side)
        return seat(sent.astype(np.int64), np.full(grid.side, world.fresh), world.root_discount, seeds, salt)

    return root


def score(docs):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) of every row.

    Tokens are the words of the text, A-Z in lower case, and one end.  Rows of the held-out fold
    don't teach.  The symbols are the training words and one for all other words.  ``base_score``
    adds one to the count of each symbol.  ``score`` is the text's log10 probability in the model:
    a token is drawn in the restaurant of the word before it, of which every word that occurs
    before another in a training text has one; all contexts share one parent restaurant, whose own
    draws are all symbols alike.  So a text of unknown words is as unlikely as each of them is.
    Discounts follow from how many counts are one and two.  Each Gibbs sweep draws the tables of
    every dish in every context anew, given the tables of each restaurant after the sweep before,
    and then those of the parent; a token's predictive probability is averaged over the last
    ``KEPT`` sweeps, and its logarithm is kept to 2e-10.

    Null and empty texts are one end.  Rows without doc_id teach and are scored with a null id;
    rows that repeat count as often.  Without training tokens every probability is 1.  An empty
    table gives no rows.
    """
    spelled, spelled_folder = settled(_blocks(docs), "lm-blocks")
    listed, listed_folder = settled(_listed(spelled), "lm-listed")
    words, words_folder = numbered(listed.groupBy("word").agg(F.sum("n").alias("c")), [F.xxhash64("word"), F.col("word")], "place")
    size = words.agg(F.count("*").alias("all"), F.count_if(F.col("c") > 0).alias("known"), F.coalesce(F.sum("c"), F.lit(0)).alias("total")).first()
    numbers = listed.join(words.select("word", "place", "c"), "word").select("block", "key", "place", "c")
    # The lists are packed, and gone from the disk, before the texts are shuffled to meet them.
    packed, packed_folder = settled(_numbers_of(numbers), "lm-numbers", listed_folder, words_folder)
    blocks, _ = settled(spelled.drop("words").join(packed, "block"), "lm-texts", spelled_folder, packed_folder)
    grid = _Grid(blocks.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0], size["all"])
    cells, cells_folder = settled(_cells(_asked(blocks, grid), grid), "lm-cells")
    # The first state has one table for every pair and, in the parent, for every word.
    state, folder = settled(_summed(cells, grid, lambda row, keys, n: np.ones(len(keys)), lambda sent, segment: np.minimum(sent, 1)), "lm-sums")
    pairs, dishes = _totals(state)
    discounts = _discount(pairs["one"], pairs["two"]), _discount(dishes["one"], dishes["two"])
    worlds, states, folders = [_World(*discounts, size["known"], dishes["total_a"], dishes["total_b"])], [state], [cells_folder, folder]
    for sweep in range(SWEEPS):
        # Only sums are kept: the same state and salt draw the same tables again when texts are scored.
        draws = _draw(grid, worlds[-1], 2 * sweep), _draw_root(grid, worlds[-1], 2 * sweep + 1)
        state, folder = settled(_summed(_beside(cells, states[-1], grid), grid, *draws), "lm-sums")
        dishes = _totals(state)[1]
        worlds, states, folders = worlds + [_World(*discounts, size["known"], dishes["total_a"], dishes["total_b"])], states + [state], folders + [folder]
    first = len(states) - KEPT - 1
    last = None
    for k, state in enumerate(states[first:]):
        some = state.select("side", "segment", F.struct(F.lit(k).alias("k"), "a", "b").alias("x"))
        last = some if last is None else last.unionAll(some)
    x = F.array_sort(F.collect_list("x")).alias("x")  # KEPT + 1 of them
    last = last.groupBy("side", "segment").agg(x).select("side", "segment", F.col("x.a").alias("a"), F.col("x.b").alias("b"))
    answers, _ = settled(_answers(_asked(blocks, grid).drop("n"), _beside(cells, last, grid), grid, worlds[first:], first), "lm-answers", *folders)
    return _scored(blocks, answers, grid, int(size["total"]), int(size["known"]))


def _answers(asked, model, grid, worlds, first):
    """(block, cell, p): the log10 probability of each pair that a block asks for, in the order of its keys.

    ``worlds`` are the states before and after the kept sweeps, of which ``first`` is the number of the first one.
    """
    schema = pa.schema([("block", pa.int64()), ("cell", pa.int64()), ("p", pa.binary())])

    def run(asks, cell):
        if not asks.num_rows:
            return schema.empty_table()
        row = cell.to_pylist()[0]
        wanted = [_opened_keys(k.as_py()) for k in asks["keys"]]
        ends = np.cumsum([len(k) for k in wanted])[:-1]
        distinct, place = np.unique(np.concatenate(wanted), return_inverse=True)
        place = place.astype(np.int32)
        del wanted
        keys, n = _opened_keys(row["keys"]), _opened(row["n"], "<i8")
        taught = np.zeros(len(distinct), dtype=bool)
        taught[np.searchsorted(distinct, keys)] = True  # every pair of a training text is asked for by its block
        before, word = _places(distinct)
        opened = [_opened(x, "<f8") for x in row["ub"]]
        parents = [w.parent(_opened(a, "<f8"), _opened(b, "<f8")) for w, a, b in zip(worlds, row["wa"], row["wb"])]
        p = np.zeros(len(distinct))
        for k in range(1, len(worlds)):
            tables = worlds[k - 1].tables_of(grid, row["i"], row["j"], keys, n, opened[k - 1], parents[k - 1], 2 * (first + k - 1))
            p[taught] += n - worlds[k].discount * tables
            p += (STRENGTH + worlds[k].discount * opened[k][before]) * parents[k][word]
        p = np.log10(p / (len(worlds) - 1) / (STRENGTH + _opened(row["ua"][0], "<f8")[before]))
        return pa.table([asks["block"], asks["cell"], pa.array([_packed_logs(x) for x in np.split(p[place], ends)], type=pa.binary())], schema=schema)

    return asked.groupBy("cell").cogroup(model.groupBy("cell")).applyInArrow(run, "block long, cell long, p binary")


def _scored(blocks, answers, grid, total, vocabulary):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("base_score", pa.float64()), ("score", pa.float64())])

    def run(block, looked):
        if not block.num_rows:
            return schema.empty_table()
        tokens, lengths = _opened(block["tokens"][0].as_py(), "<i4"), block["lengths"][0].values.to_numpy()
        c, numbers = (_opened(block[k][0].as_py(), "<i8") for k in ("counts", "numbers"))
        found, place = np.unique(grid.codes(tokens, numbers), return_inverse=True)
        by_cell = dict(zip(looked["cell"].to_pylist(), looked["p"]))
        p = np.concatenate([_opened_logs(by_cell[int(cell)].as_py()) for cell, _, _ in _pieces(found)])
        starts = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)[:-1]))
        base = np.log10((c + 1) / (total + vocabulary + 1))
        return pa.table([
            block["doc_ids"][0].values, pa.array(~block["train"][0].values.to_numpy(zero_copy_only=False)), pa.array(lengths.astype(np.int64)),
            pa.array(np.add.reduceat((c > 0).astype(np.int64)[tokens], starts)), pa.array(np.add.reduceat(base[tokens], starts)),
            pa.array(np.add.reduceat(p[place], starts)),
        ], schema=schema)

    scored = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
