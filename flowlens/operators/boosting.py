"""Softmax gradient boosting on histograms, in one barrier stage.

Each task of the stage keeps its rows on local disk, as bins, and sweeps them in blocks. The trees
of all classes of a round grow together, level by level. A task sums slopes and curvatures of its
rows by node and bin, of the smaller child of each split only; the sums of a class and a column meet
in one task, which takes the other child as the parent less the smaller one and offers its best
split of every node. All tasks then read the offers and agree on the same trees. Slopes are rounded
to whole multiples of a small unit, so sums are exact and the trees are the same for any
partitioning.

Columns of two values that exclude each other (one-hot blocks) are bundled into one column.
Task 0 saves the trees every ``SAVE_EVERY`` rounds; a stage that is tried again goes on there.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.operators import disk
from flowlens.operators.exchange import Peers
from flowlens.operators.selection import seeded_sample
from flowlens.operators.trees import LEAF, Trees
from flowlens.session import shared_dir, stage

#: Bins of a column, rows that their bounds come from, and tasks of the stage at most.
MAX_BINS, EDGE_ROWS, MAX_TASKS = 256, 100_000, 64
#: Cells of columns that are counted together.
MOST_CELLS = 1024
#: Regularisation of leaf values, least curvature of a child, least gain of a split.
RIDGE, LEAST_COVER, LEAST_GAIN = 1.0, 1.0, 1e-6
SAVE_EVERY = 25
#: Slopes are whole multiples of the total weight (as a power of two) over this, so that sums of
#: any rows stay exact; losses, which may be larger, of so many units.
UNITS, LOSS_UNITS = float(1 << 52), float(1 << 12)
NODE_SCHEMA = ("round int, class_idx int, node int, feature int, threshold double, value double, "
               "cover double, gain double, loss double")


def bin_edges(values: np.ndarray, bins: int = MAX_BINS) -> np.ndarray:
    """Bounds between values: midpoints of neighbours, or of quantiles where there are too many."""
    distinct = np.unique(values)
    if len(distinct) > bins:
        ranks = np.linspace(0, len(values) - 1, bins + 1)[1:-1].round().astype(int)
        cuts = np.unique(np.sort(values)[ranks])
        at = np.searchsorted(distinct, cuts)
        at = at[at < len(distinct) - 1]
    else:
        at = np.arange(len(distinct) - 1)
    return distinct[at] + (distinct[at + 1] - distinct[at]) / 2


def column_edges(train: DataFrame, key: str, rows: int = EDGE_ROWS) -> list[np.ndarray]:
    """The bounds of every slot of ``features``, from a seeded sample of at most ``rows`` rows."""
    sample = seeded_sample(train.select(key, "features"), rows, key=key)
    sample = sample.select(vector_to_array("features").alias("x"), F.lit(True).alias("all"))

    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(pdf["x"].to_numpy())
        return pd.DataFrame({"slot": np.arange(x.shape[1]),
                             "edges": [bin_edges(x[:, j]).tolist() for j in range(x.shape[1])]})

    found = sample.groupBy("all").applyInPandas(find, "slot int, edges array<double>").collect()
    return [np.array(r["edges"]) for r in sorted(found, key=lambda r: r["slot"])]


def binned(train: DataFrame, edges: list[np.ndarray], key: str) -> DataFrame:
    """``key, y, weight, bins``: one byte a slot."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = np.stack(batch["x"].to_numpy())
                b = np.stack([np.searchsorted(e, x[:, j], side="left")
                              for j, e in enumerate(edges)], axis=1).astype(np.uint8)
                yield pd.DataFrame({key: batch[key], "y": batch["y"], "weight": batch["weight"],
                                    "bins": [row.tobytes() for row in b]})

    kind = dict(train.dtypes)[key]
    return train.select(key, F.col("y").cast("int").alias("y"), "weight",
                        vector_to_array("features").alias("x")).mapInPandas(
        cut, f"`{key}` {kind}, y int, weight double, bins binary")


class Columns:
    """The histogram's columns: slots of several bins, and bundles of slots of two.

    Columns of few bins are counted together: a group has one cell for every combination of the
    bins of its members, whose own sums follow from the group's.
    """

    def __init__(self, widths: list[int], conflicts: np.ndarray, most_cells: int = MAX_BINS):
        self.members: list[list[int]] = [[j] for j, w in enumerate(widths) if w > 2]
        bundles: list[list[int]] = []
        for j in (j for j, w in enumerate(widths) if w == 2):
            fits = next((b for b in bundles if len(b) < MAX_BINS - 1
                         and not any(conflicts[j, i] for i in b)), None)
            if fits is None:
                bundles.append(fits := [])
            fits.append(j)
        self.bundled = [False] * len(self.members) + [True] * len(bundles)
        self.members += bundles
        self.widths = [len(m) + 1 if b else widths[m[0]] for m, b in zip(self.members, self.bundled)]
        self.groups: list[list[int]] = []
        self.cells: list[int] = []
        for c in sorted(range(len(self.widths)), key=lambda c: -self.widths[c]):
            fits = next((i for i, n in enumerate(self.cells) if n * self.widths[c] <= most_cells), None)
            if fits is None:
                fits = len(self.groups)
                self.groups.append([])
                self.cells.append(1)
            self.groups[fits].append(c)
            self.cells[fits] *= self.widths[c]
        self.group = {c: i for i, own in enumerate(self.groups) for c in own}

    def of(self, bins: np.ndarray) -> np.ndarray:
        """``(columns, rows)`` from ``(rows, slots)``."""
        out = np.zeros((len(self.members), len(bins)), np.uint8)
        for c, (slots, bundled) in enumerate(zip(self.members, self.bundled)):
            if bundled:
                for i, j in enumerate(slots, 1):
                    out[c][bins[:, j] > 0] = i
            else:
                out[c] = bins[:, slots[0]]
        return out

    def cells_of(self, bins: np.ndarray) -> np.ndarray:
        """``(groups, rows)``: the cell of every row, the group's last member varying fastest."""
        columns = self.of(bins)
        out = np.zeros((len(self.groups), len(bins)), np.uint16)
        for i, own in enumerate(self.groups):
            for c in own:
                out[i] *= np.uint16(self.widths[c])
                out[i] += columns[c]
        return out

    def bins_in(self, c: int) -> np.ndarray:
        """The bin of column c in every cell of its group."""
        own = self.groups[self.group[c]]
        shape = [self.widths[x] for x in own]
        return np.indices(shape, np.int16)[own.index(c)].ravel()

    def apart(self, sums: np.ndarray, i: int) -> dict[int, np.ndarray]:
        """The sums of each member of group i from those of its cells, ``(..., cells)``."""
        own = self.groups[i]
        shape = [self.widths[c] for c in own]
        first = sums.ndim - 1
        whole = sums.reshape(*sums.shape[:-1], *shape)
        return {c: whole.sum(axis=tuple(first + j for j in range(len(own)) if j != at))
                for at, c in enumerate(own)}

    def slot(self, c: int, place: int) -> tuple[int, int]:
        """The slot that a split of column c tests, and the last bin that goes left."""
        return (self.members[c][place], 0) if self.bundled[c] else (self.members[c][0], place)


def add_at(total: np.ndarray, cell: np.ndarray, weight: np.ndarray) -> None:
    if len(total) > len(cell):
        np.add.at(total, cell, weight)
    else:
        total += np.bincount(cell, weight, len(total))


class Grower:
    """One task's share of the work.

    What it keeps for each row lies on local disk (``disk``) and is swept in blocks: its cells,
    class and weight, and for each class its margin, slope, curvature and node.
    """

    def __init__(self, slots: np.ndarray, y: np.ndarray, weight: np.ndarray, n_slots: list[int],
                 classes: int, depth: int, rate: float, peers: Peers):
        self.peers, self.depth, self.rate, self.y, self.weight = peers, depth, rate, y, weight
        self.targets = [1] if classes == 2 else list(range(classes))
        self.n, k = len(y), len(self.targets)
        two = [j for j, w in enumerate(n_slots) if w == 2]
        met = np.zeros((len(two), len(two)), bool)
        for part in disk.blocks(self.n):
            ones = (slots[part][:, two] > 0).astype(np.float32)
            met |= ones.T @ ones > 0
        peers.share(np.concatenate([met.ravel().astype(np.float64), [weight.sum()]]))
        all_ = np.stack(peers.each(np.float64))
        conflicts = np.zeros((len(n_slots), len(n_slots)), bool)
        conflicts[np.ix_(two, two)] = all_[:, :-1].any(axis=0).reshape(len(two), len(two))
        n_nodes = (2 << depth) - 1
        self.columns = Columns(n_slots, conflicts, min(MOST_CELLS, max(MAX_BINS, (1 << 20) // n_nodes)))
        self.unit = 2.0 ** np.ceil(np.log2(all_[:, -1].sum() or 1.0)) / UNITS
        self.cells = disk.zeros((len(self.columns.groups), self.n), np.uint16)
        for part in disk.blocks(self.n):
            self.cells[:, part] = self.columns.cells_of(slots[part])
        self.margins = disk.zeros((k, self.n), np.float64)
        self.slope, self.curve = (disk.zeros((k, self.n), np.float64) for _ in range(2))
        self.heap = disk.zeros((k, self.n), np.int16 if n_nodes < 1 << 15 else np.int32)
        self.pairs = [(k, c) for k in range(len(self.targets)) for c in range(len(self.columns.widths))]
        self.owned = [i for i in range(len(self.pairs)) if i % peers.size == peers.rank]

    def slopes(self, part: slice) -> tuple[np.ndarray, np.ndarray, float]:
        """Slope and curvature of every class and row in units, and the summed loss."""
        y, margins = self.y[part].astype(np.int64), self.margins[:, part]
        if len(self.targets) == 1:
            p = 1 / (1 + np.exp(-margins))
            hit = (y == 1)[None, :]
            curve = p * (1 - p)
            loss = np.logaddexp(0, np.where(hit, -margins, margins))[0]
        else:
            z = margins - margins.max(axis=0, initial=-np.inf)
            p = np.exp(z)
            total = p.sum(axis=0)
            p /= total
            hit = np.arange(len(self.targets))[:, None] == y[None, :]
            curve = 2 * p * (1 - p)
            loss = np.log(total) - z[y, np.arange(len(y))] if len(y) else total
        weight = self.weight[part]
        g = np.rint((p - hit) * weight / self.unit)
        h = np.rint(np.maximum(curve, 1e-16) * weight / self.unit)
        return g, h, float(np.rint(loss * weight / (self.unit * LOSS_UNITS)).sum())

    def _by_pair(self, sums: list[list[np.ndarray]]) -> list[np.ndarray]:
        """From sums of (slots, cells) by class and group, slopes before curvatures: (slots, 2,
        width) for each (class, column)."""
        out = []
        for own in sums:
            apart = {}
            for i, both in enumerate(own):
                apart |= self.columns.apart(both, i)
            out += [apart[c] for c in range(len(self.columns.widths))]
        return out

    def _start(self) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, float]:
        """Put all rows at the roots, renew slopes and curvatures, and sum them."""
        k = len(self.targets)
        sums = [[np.zeros((1, 2, w)) for w in self.columns.cells] for _ in range(k)]
        tops, loss = np.zeros((2, k)), 0.0
        for part in disk.blocks(self.n):
            g, h, lost = self.slopes(part)
            self.slope[:, part], self.curve[:, part], self.heap[:, part] = g, h, 0
            tops += [g.sum(axis=1), h.sum(axis=1)]
            loss += lost
            for i in range(len(self.columns.groups)):
                cell = self.cells[i, part].astype(np.int64)
                for j in range(k):
                    add_at(sums[j][i][0, 0], cell, g[j])
                    add_at(sums[j][i][0, 1], cell, h[j])
        return self._by_pair(sums), *tops, loss

    def _step(self, level: int, tests: dict[int, tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, int]:
        """How rows move on: the group that each node tests, and by node and cell of that group the
        next node, with as many cells for every node."""
        n_nodes, width = (2 << level) - 1, max(self.columns.cells)
        group = np.zeros(n_nodes, np.int64)
        to = np.repeat(np.arange(n_nodes, dtype=self.heap.dtype), width).reshape(n_nodes, width)
        digits: dict[int, np.ndarray] = {}
        for node, (c, place) in tests.items():
            if c not in digits:
                digits[c] = self.columns.bins_in(c)
            value = digits[c]
            right = value == place + 1 if self.columns.bundled[c] else value > place
            group[node] = self.columns.group[c]
            to[node, :len(value)] = 2 * node + 1 + right
        return group, to.ravel(), width

    def _descend(self, k: int, level: int, tests: dict[int, tuple[int, int]],
                 place_of: np.ndarray | None, count: int) -> list[np.ndarray]:
        """Move the rows of class k one level down and sum those whose new node has a place."""
        sums = [np.zeros((2, count * w)) for w in self.columns.cells] if count else []
        if not tests:
            return [s.reshape(2, count, -1).swapaxes(0, 1) for s in sums]
        group, to, width = self._step(level, tests)
        flat = self.cells.reshape(-1)
        for part in disk.blocks(self.n):
            heap = self.heap[k, part].astype(np.int64)
            # nodes above this level keep their rows
            at = group.take(heap)
            at *= self.n
            at += np.arange(part.start, part.stop)
            heap *= width
            heap += flat.take(at)
            heap = to.take(heap)
            self.heap[k, part] = heap
            if not count:
                continue
            slot = place_of.take(heap)
            rows = np.flatnonzero(slot >= 0)
            slot = slot.take(rows)
            g, h = self.slope[k, part].take(rows), self.curve[k, part].take(rows)
            for i, w in enumerate(self.columns.cells):
                cell = slot * w
                cell += self.cells[i, part].take(rows)
                add_at(sums[i][0], cell, g)
                add_at(sums[i][1], cell, h)
        return [s.reshape(2, count, -1).swapaxes(0, 1) for s in sums]

    def _met(self, own: list[np.ndarray], extra: list[float]) -> tuple[dict, np.ndarray]:
        """The sums over all tasks of the pairs this task owns, and of ``extra``."""
        # what a task owns lies together, so that it reads no more than that
        order = sorted(range(len(own)), key=lambda i: (i % self.peers.size, i))
        flat = np.concatenate([np.array(extra, np.float64), *[own[i].ravel() for i in order]])
        starts = dict(zip(order, np.cumsum([len(extra), *[own[i].size for i in order]])))
        self.peers.share(flat)
        total = {i: np.zeros(own[i].shape) for i in self.owned}
        tops = np.zeros(len(extra))
        first = int(starts[self.owned[0]]) if self.owned else 0
        size = sum(own[i].size for i in self.owned)
        for rank in range(self.peers.size):
            if extra:
                tops += self.peers.of(rank, np.float64, 0, len(extra))
            theirs = self.peers.of(rank, np.float64, first, size)
            for i in self.owned:
                at = starts[i] - first
                total[i] += theirs[at:at + own[i].size].reshape(own[i].shape)
        return total, tops

    def _offers(self, sums: dict, known: list[np.ndarray]) -> np.ndarray:
        """The best split of every node and owned pair: gain, place, left slope, left curvature."""
        out = []
        for i in self.owned:
            k, c = self.pairs[i]
            both = sums[i]
            if not len(both):
                continue
            node = known[k][:, :, None]
            left = node - both[:, :, 1:] if self.columns.bundled[c] else \
                np.cumsum(both, axis=2)[:, :, :-1]
            right = node - left
            u = self.unit
            gain = sum((a[:, 0] * u) ** 2 / (a[:, 1] * u + RIDGE) for a in (left, right)) \
                - (node[:, 0] * u) ** 2 / (node[:, 1] * u + RIDGE)
            gain[(left[:, 1] * u < LEAST_COVER) | (right[:, 1] * u < LEAST_COVER)] = -1
            place = gain.argmax(axis=1)
            rows = np.arange(len(gain))
            out.append(np.stack([gain[rows, place], place.astype(float), left[rows, 0, place],
                                 left[rows, 1, place]], axis=1).ravel())
        return np.concatenate(out) if out else np.zeros(0)

    def _best(self, offers: np.ndarray, n_nodes: list[int]) -> list[np.ndarray]:
        """For each class, (nodes, 5): gain, column, place, left slope, left curvature."""
        best = [np.full((n, 5), -1.0) for n in n_nodes]
        self.peers.share(offers)
        for rank in range(min(self.peers.size, len(self.pairs))):
            theirs, at = self.peers.of(rank, np.float64), 0
            for i in range(rank, len(self.pairs), self.peers.size):
                k, c = self.pairs[i]
                n = n_nodes[k]
                offer = theirs[at:at + 4 * n].reshape(n, 4)
                at += 4 * n
                # of equal gains the first column wins, whichever task offers it
                wins = (offer[:, 0] > best[k][:, 0]) | ((offer[:, 0] == best[k][:, 0])
                                                        & (c < best[k][:, 1]))
                best[k][wins] = np.insert(offer, 1, c, axis=1)[wins]
        return best

    def round(self, edges: list[np.ndarray]) -> tuple[list[dict], float]:
        """Grow one tree a class; rows of nodes, and the loss before the round."""
        n = len(self.targets)
        nodes: list[dict[int, tuple]] = [{} for _ in range(n)]  # heap: feature, threshold, g, h, gain
        active: list[list[int]] = [[0] for _ in range(n)]
        own, *tops = self._start()
        sums, tops = self._met(own, [*tops[0], *tops[1], tops[2]])
        known = [np.array([[tops[k], tops[n + k]]]) for k in range(n)]
        for k in range(n):
            nodes[k][0] = (LEAF, 0.0, tops[k], tops[n + k], 0.0)
        for level in range(self.depth):
            best = self._best(self._offers(sums, known), [len(a) for a in active])
            pairs: list[list[tuple]] = [[] for _ in range(n)]  # left heap, place of parent, left is small
            tests: list[dict[int, tuple[int, int]]] = [{} for _ in range(n)]  # heap: column, place
            for k in range(n):
                for j, (node, (gain, c, place, lg, lh)) in enumerate(zip(active[k], best[k].tolist())):
                    if gain <= LEAST_GAIN:
                        continue
                    c, place = int(c), int(place)
                    slot, last = self.columns.slot(c, place)
                    _, _, pg, ph, _ = nodes[k][node]
                    nodes[k][node] = (slot, float(edges[slot][last]), pg, ph, gain)
                    nodes[k][2 * node + 1] = (LEAF, 0.0, lg, lh, 0.0)
                    nodes[k][2 * node + 2] = (LEAF, 0.0, pg - lg, ph - lh, 0.0)
                    tests[k][node] = c, place
                    pairs[k].append((2 * node + 1, j, lh <= ph - lh))
            # the smaller children are summed, the others follow from their parents
            places, counts, active, known, parents = [], [], [], [], []
            for k in range(n):
                place_of = np.full((4 << level) - 1, -1)
                kept = [(left, j, small) for left, j, small in pairs[k] if level + 1 < self.depth and any(
                    nodes[k][x][3] * self.unit >= 2 * LEAST_COVER for x in (left, left + 1))]
                for s, (left, _, small) in enumerate(kept):
                    place_of[left if small else left + 1] = s
                places.append(place_of)
                counts.append(len(kept))
                parents.append((np.array([j for _, j, _ in kept], np.int64),
                                np.array([s for _, _, s in kept], bool)))
                active.append([x for left, _, _ in kept for x in (left, left + 1)])
                known.append(np.array([nodes[k][x][2:4] for x in active[k]]).reshape(-1, 2))
            own = [self._descend(k, level, tests[k], places[k], counts[k]) for k in range(n)]
            if not any(counts):
                break
            smaller, _ = self._met(self._by_pair(
                [s or [np.zeros((0, 2, w)) for w in self.columns.cells] for s in own]), [])
            grown = {}
            for i in self.owned:
                j, small = parents[self.pairs[i][0]]
                other = sums[i][j] - smaller[i]
                first = small[:, None, None]
                grown[i] = np.stack([np.where(first, smaller[i], other),
                                     np.where(first, other, smaller[i])], axis=1).reshape(
                                         -1, *smaller[i].shape[1:])
            sums = grown
        out = []
        for k, target in enumerate(self.targets):
            value = np.zeros((2 << self.depth) - 1)
            for node, (slot, threshold, sg, sh, gain) in nodes[k].items():
                leaf = -self.rate * sg * self.unit / (sh * self.unit + RIDGE)
                value[node] = leaf if slot == LEAF else 0.0
                out.append({"class_idx": target, "node": node, "feature": slot,
                            "threshold": threshold, "value": value[node],
                            "cover": sh * self.unit, "gain": gain})
            for part in disk.blocks(self.n):
                self.margins[k, part] += value.take(self.heap[k, part])
        return out, float(tops[-1]) * self.unit * LOSS_UNITS

    def replay(self, rows: pd.DataFrame, edges: list[np.ndarray], slots: np.ndarray) -> None:
        """Margins after the saved trees; ``slots`` are the rows' bins by slot."""
        trees = [(self.targets.index(target), sorted(tree.itertuples(), key=lambda r: r.node))
                 for (_, target), tree in rows.groupby(["round", "class_idx"], sort=True)]
        for part in disk.blocks(self.n):
            own = np.ascontiguousarray(slots[part].T)
            for k, table in trees:
                heap, value = np.zeros(own.shape[1], np.int64), np.zeros(own.shape[1])
                for r in table:
                    here = heap == r.node
                    if r.feature == LEAF:
                        value[here] = r.value
                    else:
                        last = int(np.searchsorted(edges[r.feature], r.threshold))
                        heap[here] = 2 * r.node + 1 + (own[r.feature, here] > last)
                self.margins[k, part] += value


def stored(batches: Iterator[pd.DataFrame], n_slots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins by slot, class and weight of a task's rows, written to local disk as they come."""
    files = [disk.scratch_file() for _ in range(3)]
    n = 0
    for batch in batches:
        n += len(batch)
        for file, part in zip(files, (b"".join(batch["bins"]), batch["y"].to_numpy(np.int16).tobytes(),
                                      batch["weight"].to_numpy(np.float64).tobytes())):
            file.write(part)
    return tuple(disk.mapped(file, dtype, shape) for file, dtype, shape in zip(
        files, (np.uint8, np.int16, np.float64), ((n, n_slots), (n,), (n,))))


def fit(train: DataFrame, classes: int, rounds: int = 300, depth: int = 8, rate: float = 0.1,
        key: str = "flow_id", tasks: int | None = None, folder: str | None = None) -> tuple[DataFrame, int]:
    """The nodes of all trees as a stored table (``NODE_SCHEMA``) from ``key, features, y, weight``,
    and the number of feature slots.

    ``loss`` is the mean weighted loss before the round. The stage needs ``tasks`` free cores at
    once (all cores, at most ``MAX_TASKS``), each with its share of the rows on local disk: two bytes
    for every group of columns and 26 for every class. ``folder`` names the shared folder of an earlier fit of the
    same rows that was cut short; its saved trees are taken over.
    """
    spark = train.sparkSession
    tasks = tasks or max(1, min(MAX_TASKS, spark.sparkContext.defaultParallelism))
    edges = column_edges(train, key)
    rows = stage(binned(train, edges, key), "binned")
    folder = folder or f"{shared_dir(spark)}/boost-{uuid.uuid4().hex[:12]}"
    n_slots = [len(e) + 1 for e in edges]

    def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import BarrierTaskContext

        slots, y, weight = stored(batches, len(edges))
        peers = Peers(BarrierTaskContext.get(), folder)
        task = Grower(slots, y, weight, n_slots, classes, depth, rate, peers)
        saved, done = None, 0
        place = peers.folder and f"{os.path.dirname(peers.folder)}/trees.pkl"
        # the task that saves tells which state is read, so all start alike
        peers.share(np.array([float(bool(place) and peers.rank == 0 and os.path.exists(place))]))
        if peers.of(0, np.float64)[0]:
            saved = pd.read_pickle(place)
            done = int(saved["round"].max()) + 1
            task.replay(saved, edges, slots)
        del slots
        peers.share(np.array([weight.sum()]))
        total = sum(float(a[0]) for a in peers.each(np.float64)) or 1.0
        found = [] if saved is None else [saved]
        for i in range(done, rounds):
            nodes, loss = task.round(edges)
            if peers.rank == 0:
                found.append(pd.DataFrame(nodes).assign(round=i, loss=loss / total))
                if place and (i + 1) % SAVE_EVERY == 0:
                    pd.concat(found).to_pickle(place + ".part", compression=None)
                    os.rename(place + ".part", place)
        if peers.rank == 0:
            for part in found:
                yield part[[c.split()[0] for c in NODE_SCHEMA.split(", ")]]

    dealt = rows.select("y", "weight", "bins").repartition(tasks)
    return stage(dealt.mapInPandas(grow, NODE_SCHEMA, barrier=True), "boosted-nodes"), len(edges)


def to_trees(nodes: pd.DataFrame) -> Trees:
    """Flat arrays, ordered by class, then round."""
    keys = nodes[["class_idx", "round"]].drop_duplicates().sort_values(["class_idx", "round"])
    n = len(keys)
    depth = max(1, int(np.log2(nodes["node"].max() + 1)) if n else 1)
    width = (2 << depth) - 1
    at = pd.MultiIndex.from_frame(keys).get_indexer(
        pd.MultiIndex.from_frame(nodes[["class_idx", "round"]]))
    out = Trees(keys["class_idx"].to_numpy().astype(np.int16), np.full((n, width), LEAF, np.int32),
                *(np.zeros((n, width)) for _ in range(3)))
    for name in ("feature", "threshold", "value", "cover"):
        getattr(out, name)[at, nodes["node"].to_numpy()] = nodes[name].to_numpy()
    return out
