"""Weighted acyclic automata over words: built from sorted counted phrases, united, composed, walked.

A path spells a key word by word; the weight of a transition is the count of the path that ends with
it (0 where the path is only the beginning of others). States with the same transitions are one state.
All work goes layer by layer in arrays: paths are a few words long, however many there are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: An automaton as columns of a table: words by line breaks, which none has, and the numbers' own bytes.
COLUMNS = "words binary, first binary, label binary, weight binary, target binary"
_KINDS = (np.int32, np.int32, np.int64, np.int32)


class Layer(NamedTuple):
    """Nodes of one depth of a trie, sorted by parent (a node of the layer before) and label."""

    parent: np.ndarray
    label: np.ndarray
    weight: np.ndarray


class Trie(NamedTuple):
    words: list[bytes]  # in byte order; a label is a place in this list
    layers: list[Layer]


class Automaton(NamedTuple):
    """Transitions of state s are those from first[s] to first[s + 1], labels rising. State 0 has none, the last is the start."""

    words: list[bytes] | pa.Array  # as they come from a table, words stay there
    first: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    target: np.ndarray


def order_codes(columns: Sequence[np.ndarray], labels: int) -> np.ndarray:
    """One number for each row of these columns, in the order of the rows, equal only for equal rows."""
    code, bound = columns[0].astype(np.int64), max(labels, 1)
    for column in columns[1:]:
        if bound > (1 << 62) // max(labels, 1):
            code = np.unique(code, return_inverse=True)[1].astype(np.int64)
            bound = len(code)
        code = code * labels + column
        bound *= max(labels, 1)
    return code


def summed(paths: np.ndarray, counts: np.ndarray, labels: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order, with the sums of their counts."""
    if not len(paths):
        return paths, counts
    code = order_codes(paths.T, labels)
    order = np.argsort(code, kind="stable")
    code = code[order]
    begin = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    return paths[order[begin]], np.add.reduceat(counts[order], begin)


def trie_of(words: list[bytes], paths: np.ndarray, counts: np.ndarray, totals: bool = False) -> Trie:
    """Sorted distinct paths of one length as a trie; with `totals` the first transitions carry the sums of their counts."""
    layers = []
    fresh = np.zeros(len(paths), bool)
    fresh[:1] = True
    node = np.zeros(len(paths), np.int64)
    for depth in range(paths.shape[1]):
        fresh[1:] |= paths[1:, depth] != paths[:-1, depth]
        begin = np.flatnonzero(fresh)
        if depth == paths.shape[1] - 1:
            weight = counts[begin]
        elif totals and depth == 0 and len(begin):
            weight = np.add.reduceat(counts, begin)
        else:
            weight = np.zeros(len(begin), np.int64)
        layers.append(Layer(node[begin], paths[begin, depth].astype(np.int64), weight.astype(np.int64)))
        node = np.cumsum(fresh) - 1
    return Trie(words, layers)


def minimal(trie: Trie) -> Automaton:
    """From the deepest layer up, every node becomes the state with its transitions; a register knows those that exist."""
    register: dict[bytes, int] = {}
    sizes = [np.zeros(1, np.int64)]
    parts: list[np.ndarray] = []
    state = np.zeros(0, np.int64)
    known = 1
    for depth in range(len(trie.layers) - 1, -1, -1):
        layer = trie.layers[depth]
        if not len(state):
            state = np.zeros(len(layer.label), np.int64)
        table = np.stack([layer.label, layer.weight, state], axis=1) if len(layer.label) else np.zeros((0, 3), np.int64)
        raw = table.tobytes()
        parents = len(trie.layers[depth - 1].label) if depth else 1
        begins = np.searchsorted(layer.parent, np.arange(parents + 1)).tolist()
        above, new = [], []
        for k in range(parents):
            begin, end = begins[k], begins[k + 1]
            if begin == end and depth:
                above.append(0)
                continue
            key = raw[24 * begin : 24 * end]
            found = register.get(key)
            if found is None:
                found = register[key] = known
                known += 1
                new.append(k)
            above.append(found)
        state = np.array(above, np.int64)
        at = np.array(begins, np.int64)
        sizes.append((at[1:] - at[:-1])[new])
        parts.append(table[_spread(at[:-1][new], (at[1:] - at[:-1])[new])])
    first = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]) if trie.layers else np.zeros(3, np.int64)
    moves = np.concatenate(parts) if parts else np.zeros((0, 3), np.int64)
    return Automaton(trie.words, first, moves[:, 0], moves[:, 1], moves[:, 2])


def _spread(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places begin, begin + 1 ... of several stretches in a row."""
    total = int(sizes.sum())
    return np.arange(total) + np.repeat(begins - np.cumsum(sizes) + sizes, sizes)


def united(automata: list[Automaton]) -> Trie:
    """The union: all automata are walked at once, equal paths meet in one node and their weights add up."""
    listed = [a.words if isinstance(a.words, pa.Array) else pa.array(a.words, pa.binary()) for a in automata]
    met = pa.concat_arrays(listed or [pa.array([], pa.binary())]).dictionary_encode()
    order = pc.array_sort_indices(met.dictionary)
    words = met.dictionary.take(order).to_pylist()
    rank = np.empty(len(words), np.int32)
    rank[order.to_numpy()] = np.arange(len(words), dtype=np.int32)
    place = rank[met.indices.to_numpy()]
    begins = np.cumsum([0] + [len(w) for w in listed])
    states = np.cumsum([0] + [len(a.first) - 1 for a in automata])
    moves = np.cumsum([0] + [len(a.label) for a in automata])
    first = np.concatenate([a.first[:-1] + m for a, m in zip(automata, moves)] or [np.zeros(0, np.int64)])
    size = np.concatenate([np.diff(a.first) for a in automata] or [np.zeros(0, np.int64)])
    label = np.concatenate([place[b:][a.label] for a, b in zip(automata, begins)] or [np.zeros(0, np.int32)])
    weight = np.concatenate([a.weight for a in automata] or [np.zeros(0, np.int64)])
    target = np.concatenate([a.target + s for a, s in zip(automata, states)] or [np.zeros(0, np.int64)])
    node, state = np.zeros(len(automata), np.int64), states[1:] - 1
    layers = []
    while True:
        at = _spread(first[state], size[state])
        if not len(at):
            return Trie(words, layers)
        code = np.repeat(node, size[state]) * len(words) + label[at]
        order = np.argsort(code, kind="stable")
        code, at = code[order], at[order]
        fresh = np.concatenate([[True], code[1:] != code[:-1]])
        begin = np.flatnonzero(fresh)
        layers.append(Layer(code[begin] // len(words), code[begin] % len(words), np.add.reduceat(weight[at], begin)))
        node, state = np.cumsum(fresh) - 1, target[at]


def pruned(trie: Trie, depth: int, least: int) -> Trie:
    """Without the paths of `depth` transitions that weigh less than `least`, and without what only led to them. First transitions stay."""
    if len(trie.layers) < depth:
        return Trie(trie.words, trie.layers[:1])
    layers = list(trie.layers[:depth])
    keep = layers[-1].weight >= least
    for k in range(depth - 1, 0, -1):
        layers[k] = Layer(*(column[keep] for column in layers[k]))
        used = np.zeros(len(layers[k - 1].label), bool)
        used[layers[k].parent] = True
        if k > 1:  # renumber by what stays above
            layers[k] = layers[k]._replace(parent=(np.cumsum(used) - 1)[layers[k].parent])
        keep = used
    return Trie(trie.words, [layer for k, layer in enumerate(layers) if k == 0 or len(layer.label)])


def paths_of(trie: Trie, depth: int) -> np.ndarray:
    """Labels of every path of `depth` transitions, a row each, in order."""
    if len(trie.layers) < depth:
        return np.zeros((0, depth), np.int64)
    columns, node = [], np.arange(len(trie.layers[depth - 1].label))
    for layer in reversed(trie.layers[:depth]):
        columns.append(layer.label[node])
        node = layer.parent[node]
    return np.stack(columns[::-1], axis=1)


class Walk:
    """Steps through an automaton from many states at once."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        words = automaton.words.to_pylist() if isinstance(automaton.words, pa.Array) else automaton.words
        self.place = {w: k for k, w in enumerate(words)}
        self.labels = max(len(automaton.words), 1)
        self.keys = np.repeat(np.arange(len(automaton.first) - 1), np.diff(automaton.first)) * self.labels + automaton.label

    def labels_of(self, words: list[bytes]) -> np.ndarray:
        """Labels here of these words; -1 for words that no path has."""
        return np.array([self.place.get(w, -1) for w in words], np.int64)

    def step(self, states: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weight and next state; 0 and the state without transitions where there is no way on."""
        if not len(self.keys):
            return np.zeros(len(states), np.int64), np.zeros(len(states), np.int64)
        wanted = states * self.labels + labels
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        there = (self.keys[at] == wanted) & (labels >= 0)
        return np.where(there, self.automaton.weight[at], 0), np.where(there, self.automaton.target[at], 0)

    def weights(self, paths: np.ndarray) -> np.ndarray:
        """Weights of whole paths (rows of labels of this automaton)."""
        state, weight = np.full(len(paths), len(self.automaton.first) - 2, np.int64), np.zeros(len(paths), np.int64)
        for column in paths.T:
            weight, state = self.step(state, column)
        return weight


def composed(asked: Automaton, counts: Walk) -> Automaton:
    """The paths of `asked` with the weights that they have in `counts`."""
    trie = united([asked])
    here = counts.labels_of(trie.words)
    state, layers = np.full(1, len(counts.automaton.first) - 2, np.int64), []
    for layer in trie.layers:
        weight, state = counts.step(state[layer.parent], here[layer.label])
        layers.append(layer._replace(weight=weight))
    return minimal(Trie(trie.words, layers))


def only_used(words: list[bytes], paths: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The words that the paths have, and the paths by their places there."""
    used, own = np.unique(paths, return_inverse=True)
    return [words[k] for k in used.tolist()], own.reshape(paths.shape)


NAMES = ["words", "first", "label", "weight", "target"]


def to_arrays(automata: list[Automaton]) -> list[pa.Array]:
    words = pa.array([b"\n".join(a.words) for a in automata], pa.binary())
    return [words, *(pa.array([a[k].astype(kind).tobytes() for a in automata], pa.binary()) for k, kind in enumerate(_KINDS, 1))]


def from_batch(batch: pa.RecordBatch) -> Iterator[Automaton]:
    """The automata of a batch, one at a time; their words stay in Arrow."""
    words, *numbers = (batch.column(name) for name in NAMES)
    for k in range(batch.num_rows):
        listed = pc.split_pattern(words.slice(k, 1), b"\n").flatten()
        yield Automaton(listed, *(np.frombuffer(column[k].as_buffer(), kind) for column, kind in zip(numbers, _KINDS)))
