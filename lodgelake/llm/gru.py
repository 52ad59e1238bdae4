"""A gated recurrent language model in numpy with a class-factored output.

Symbols are numbers: 0 is the end of a text (and what stands before its first word), 1 to ``n_words - 1``
are the frequent words, the rest are classes of rare words.  The output first gives a softmax over classes
(groups of frequent words, then the rare classes) and, within a group, a softmax over its words, so a
symbol costs one class row and one short word row instead of the whole vocabulary.

Texts run in lanes side by side.  A lane takes one text after another; its state starts at zero with each
text and is carried from window to window, so a text of any length is scored whole while only one window
of states is held.  Training runs over whole texts in the same way, with the state carried, and only cuts
gradients at window ends (truncated backpropagation).
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from itertools import accumulate

import numpy as np

#: Size of the state; lanes and steps of a window when scoring (and symbols of texts that wait there) and when training.
STATE = 24
LANES, WINDOW = 128, 32
WAITING = 1 << 20
TRAIN_LANES, TRAIN_WINDOW = 32, 32
LEARNING_RATE = 0.08


@dataclass
class Layout:
    """Which class each symbol belongs to; the words of a group are consecutive symbols."""

    group_starts: np.ndarray  # first symbol of each group of frequent words, plus the end
    n_rare: int

    @property
    def n_words(self) -> int:
        return int(self.group_starts[-1])

    @property
    def n_groups(self) -> int:
        return len(self.group_starts) - 1

    @property
    def n_classes(self) -> int:
        return self.n_groups + self.n_rare

    @property
    def n_symbols(self) -> int:
        return self.n_words + self.n_rare

    def class_of(self) -> np.ndarray:
        groups = np.repeat(np.arange(self.n_groups), np.diff(self.group_starts))
        return np.append(groups, self.n_groups + np.arange(self.n_rare)).astype(np.int16)  # short numbers are sorted by digits


def layout_of(counts: np.ndarray, n_groups: int, n_rare: int) -> Layout:
    """Groups of about equal weight over frequent words in order of falling counts."""
    share = np.cumsum(counts) / max(counts.sum(), 1)
    group = np.minimum((np.append(0, share[:-1]) * n_groups).astype(int), n_groups - 1)
    return Layout(np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(counts)), n_rare)


def initial(layout: Layout, word_counts: np.ndarray, rare_counts: np.ndarray, seed: int = 3) -> dict[str, np.ndarray]:
    """Small random weights; the output biases start as the training counts."""
    rng = np.random.default_rng(seed)
    h = STATE
    classes = np.append(np.add.reduceat(word_counts, layout.group_starts[:-1]), rare_counts)
    flat = lambda *shape, s=0.1: rng.normal(0, s, shape).astype(np.float32)
    gates = np.zeros(3 * h, dtype=np.float32)
    gates[:h] = 1.0  # states last at first
    return {"P": flat(layout.n_symbols, 3 * h, s=0.3), "U": flat(h, 3 * h, s=0.5 / np.sqrt(h)), "b": gates,
            "C": flat(h, layout.n_classes, s=0.01), "c": np.log(classes + 0.5).astype(np.float32),
            "W": flat(layout.n_words, h, s=0.01), "w": np.log(word_counts + 0.5).astype(np.float32)}


def _by_gate(u: np.ndarray) -> np.ndarray:
    """Columns of U as three matrices: those of the two gates, negated as their sigmoids take them, and the candidate's."""
    out = np.ascontiguousarray(u.reshape(len(u), 3, STATE).swapaxes(0, 1))
    np.negative(out[:2], out=out[:2])
    return out


class Steps:
    """Arrays for so many steps of so many lanes, used again by one window after another.

    A step's numbers lie together, one gate's after another's, so numpy runs over them in one go.  ``tape`` keeps what the
    gradient needs: ``g`` (one over each gate, the candidate's share of the state, and room), ``cand`` and ``before``.
    """

    def __init__(self, steps: int, lanes: int, dtype, tape: bool):
        kept = steps if tape else 1  # without a tape all steps use the same few arrays, which stay in the cache
        self.x = np.empty((steps, 3, lanes, STATE), dtype)
        self.g, self.cand = np.empty((kept, 3 + tape, lanes, STATE), dtype), np.empty((kept, lanes, STATE), dtype)
        self.states = np.empty((steps, lanes, STATE), dtype)
        self.before = np.empty_like(self.states) if tape else None
        self.back = [(g, g[:3], g[3]) for g in self.g] if tape else []
        one = np.ones((), dtype)
        self.views = [(g, g[:2], *g, x[:2], x[2], cand, h, one) for x, g, cand, h in
                      ((self.x[t], self.g[t % kept, :3], self.cand[t % kept], self.states[t]) for t in range(steps))]

    def run(self, u: np.ndarray, rows: np.ndarray, ids: np.ndarray, begins: np.ndarray, h: np.ndarray, bias: np.ndarray | None = None) -> np.ndarray:
        """States after each step (steps x lanes).  ``rows`` are those of P (plus b, or b is ``bias``), each cut in three;
        ``u`` is U as ``_by_gate`` gives it, ``h`` the lanes' states before."""
        rows.take(ids.astype(np.intp)[:, None, :] * 3 + np.arange(3)[:, None], axis=0, out=self.x, mode="clip")
        if bias is not None:
            self.x += np.repeat(bias.reshape(3, 1, STATE), ids.shape[1], axis=1)
        if self.before is not None:
            self.before[0] = h
        starts = begins.any(axis=1).tolist()
        for t, views in enumerate(self.views):
            if starts[t]:
                h = h.copy()
                h[begins[t]] = 0
            _advance(u, h, views)
            h = self.states[t]
        if self.before is not None:
            self.before[1:] = self.states[:-1]
            self.before[begins] = 0
        return self.states


def _advance(u: np.ndarray, before: np.ndarray, views: tuple) -> None:
    """One step; its arrays are a row of ``Steps.views``."""
    g, gates, z, r, m, x_gates, x_cand, cand, h, one = views
    np.matmul(before, u, g)
    np.subtract(gates, x_gates, gates)
    np.exp(gates, gates)
    np.add(gates, one, gates)
    np.divide(m, r, cand)
    np.add(cand, x_cand, cand)
    np.tanh(cand, cand)
    np.subtract(before, cand, h)
    np.divide(h, z, h)
    np.add(h, cand, h)


def step(p: dict[str, np.ndarray], x: np.ndarray, h: np.ndarray):
    """New state and what the gradient needs; ``x`` are the inputs' rows of P plus b."""
    one = Steps(1, len(h), x.dtype, True)
    ids = np.arange(len(h))[None]
    out = one.run(_by_gate(p["U"]), np.ascontiguousarray(x).reshape(-1, STATE), ids, np.zeros(ids.shape, dtype=bool), h)
    return out[0], (one.g[0, :3], one.cand[0])


def _with_one(states: np.ndarray) -> np.ndarray:
    """States with a one behind each, for the bias."""
    out = np.empty((len(states), STATE + 1), dtype=states.dtype)
    out[:, :STATE] = states
    out[:, STATE] = 1
    return out


#: Exponentials of logits of at most this size, and their sums, are far from the limits of single precision.  In
#: training the sizes are looked at every LOOK windows: no weight moves by more than LEARNING_RATE in one.
SMALL, LOOK = 50.0, 8


class Output:
    """The output layer: weights of classes and of words, a column each, with their biases below.

    States lie between -1 and 1, so no logit is greater than the sum of its column's sizes.  While all are ``small``,
    exponentials are taken of the logits as they are, else of each row less its maximum.
    """

    def __init__(self, p: dict[str, np.ndarray], layout: Layout | None = None):
        self.classes, self.words = np.vstack([p["C"], p["c"]]), np.vstack([p["W"].T, p["w"]])
        self.blocks, self.groups = (_blocks(layout, self.words.dtype, width) if layout else [] for width in (BLOCK, 0))
        self.look()

    def look(self) -> None:
        self.small = all(np.abs(w).sum(axis=0).max() < SMALL for w in (self.classes, self.words))

    def views(self) -> dict[str, np.ndarray]:
        return {"C": self.classes[:STATE], "c": self.classes[STATE], "W": self.words[:STATE].T, "w": self.words[STATE]}

    def logits(self, states: np.ndarray, weights: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
        """Logits of states with a one, or each row's less its maximum."""
        x = np.matmul(states, weights, out=out)
        if not self.small:
            x -= x.max(axis=1, keepdims=True)
        return x


#: Words of small groups that are worked out side by side.
BLOCK = 64


def _blocks(layout: Layout, dtype, width: int) -> list[tuple[int, int, slice, np.ndarray | None]]:
    """Neighbouring groups, of ``width`` words at most if there are several: the first group, the one behind the last, their
    words, and for each group which of these words are its own (None: all).  Single words are certain: blocks begin with none."""
    starts = layout.group_starts.tolist()
    found: list[tuple[int, int]] = []
    for k in range(layout.n_groups):
        if found and starts[k + 1] - starts[found[-1][0]] <= width:
            found[-1] = (found[-1][0], k + 1)
        elif starts[k + 1] - starts[k] > 1:
            found.append((k, k + 1))
    of = np.repeat(np.arange(layout.n_groups), np.diff(layout.group_starts))
    return [(a, b, slice(starts[a], starts[b]), (np.arange(a, b)[:, None] == of[starts[a]:starts[b]]).astype(dtype) if b - a > 1 else None)
            for a, b in found]


#: Rows whose class probabilities are worked out at once: they stay in a core's cache.
CLASS_ROWS = 1024


class _WordSofts:
    """Exponentials of the logits of each row's words, for rows in order of their classes whose group has several words.

    They lie one row after another in one array, so those of all groups are taken at once; small groups lie side by side,
    each row's words of other groups set to zero.  ``parts`` are the blocks' (rows, words, exponentials), ``rows`` all
    rows, ``sums`` theirs, ``targets`` the places of their targets in ``soft`` and ``logits`` (on demand) the targets'.
    """

    def __init__(self, output: Output, layout: Layout, states: np.ndarray, targets: np.ndarray, classes: np.ndarray, logits: bool = False):
        edges = np.searchsorted(classes, np.arange(layout.n_groups + 1)).tolist()
        # rows that are shifted by a maximum are shifted by that of their own group's words
        blocks = [x for x in (output.blocks if output.small else output.groups) if edges[x[1]] > edges[x[0]]]
        rows = [slice(edges[a], edges[b]) for a, b, *_ in blocks]
        heights, widths = [x.stop - x.start for x in rows], [words.stop - words.start for _, _, words, _ in blocks]
        ends = list(accumulate((n * m for n, m in zip(heights, widths)), initial=0))
        self.soft = np.empty(ends[-1], dtype=states.dtype)
        self.parts = [(x, block[2], self.soft[i:j].reshape(n, m)) for x, block, n, m, i, j in zip(rows, blocks, heights, widths, ends, ends[1:])]
        for x, words, part in self.parts:
            output.logits(states[x], output.words[:, words], part)
        widths = np.repeat(widths, heights)
        if rows and sum(heights) == rows[-1].stop - rows[0].start:
            self.rows = np.arange(rows[0].start, rows[-1].stop)
        else:
            self.rows = np.concatenate([np.arange(x.start, x.stop) for x in rows]) if rows else np.zeros(0, np.int64)
        starts = np.cumsum(widths) - widths
        self.targets = starts + targets[self.rows] - np.repeat([words.start for _, _, words, _ in blocks], heights) if rows else self.rows
        if logits:
            self.logits = self.soft[self.targets]
        np.exp(self.soft, out=self.soft)
        for (x, _, part), (a, _, _, own) in zip(self.parts, blocks):
            if own is not None:
                part *= own.take(classes[x] - a, axis=0)
        self.sums = np.add.reduceat(self.soft, starts) if rows else self.soft


def log_probability(p: dict[str, np.ndarray], layout: Layout, class_of: np.ndarray, states: np.ndarray,
                    targets: np.ndarray, output: Output | None = None) -> np.ndarray:
    """Natural log probability of each target symbol after its state."""
    output = output or Output(p, layout)
    classes = class_of[targets]
    order = np.argsort(classes, kind="stable")
    states, targets, classes = _with_one(states.take(order, axis=0)), targets[order], classes[order]
    sums = np.empty(len(targets), dtype=states.dtype)
    ones = np.ones(layout.n_classes, dtype=states.dtype)
    for i in range(0, len(targets), CLASS_ROWS):
        rows = slice(i, i + CLASS_ROWS)
        soft = output.logits(states[rows], output.classes)
        sums[rows] = soft.ravel()[np.arange(0, soft.size, soft.shape[1]) + classes[rows]]
        sums[rows] -= np.log(np.exp(soft, out=soft) @ ones)
    words = _WordSofts(output, layout, states, targets, classes, logits=True)
    sums[words.rows] += words.logits - np.log(words.sums)
    out = np.empty_like(sums)
    out[order] = sums
    return out


def lanes_of(lengths: np.ndarray, n_lanes: int, begun: int = 0) -> list[list[int]]:
    """Texts dealt to lanes of near-equal length, longest first; lanes by falling length.  Of the first ``begun`` texts
    each has a lane of its own, which it begins."""
    heap = [(int(lengths[k]) if k < begun else 0, k) for k in range(min(n_lanes, len(lengths)))]
    lanes: list[list[int]] = [[k] if k < begun else [] for k in range(len(heap))]
    heapq.heapify(heap)
    for i in (begun + np.argsort(-lengths[begun:], kind="stable")).tolist():
        total, k = heapq.heappop(heap)
        lanes[k].append(i)
        heapq.heappush(heap, (total + int(lengths[i]), k))
    total = {k: t for t, k in heap}
    return [lanes[k] for k in sorted(total, key=lambda k: -total[k])]


class Lanes:
    """Symbols of many texts laid out lane by lane: inputs, targets, and where texts begin."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, n_lanes: int, begun: int = 0):
        starts = np.cumsum(lengths) - lengths
        # in a lane texts come as given, not longest first: training would end on short texts only
        self.texts = lanes = [sorted(lane) for lane in lanes_of(lengths, n_lanes, begun)]
        order = np.array([i for lane in lanes for i in lane], dtype=np.int64)
        n = lengths[order]
        place = np.repeat(starts[order] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        self.targets = symbols[place].astype(np.int32 if symbols.max(initial=0) > np.iinfo(np.int16).max else np.int16)
        first = np.cumsum(n) - n
        self.begins = np.zeros(len(self.targets), dtype=bool)
        self.begins[first] = True
        self.inputs = np.append(self.targets[:0].dtype.type(0), self.targets[:-1])
        self.inputs[first] = 0
        self.size = np.array([int(lengths[lane].sum()) for lane in lanes], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size

    def window(self, t0: int, steps: int) -> tuple[np.ndarray, np.ndarray | None]:
        """Places of the symbols at steps t0, t0 + 1, ... (steps x lanes that still have one at t0), and which of them are
        symbols of their lane (None: all are; the others are any place, of states that nothing is made of)."""
        t = np.arange(t0, min(t0 + steps, int(self.size[0])))[:, None]
        lanes = int(np.searchsorted(-self.size, -t0, side="left"))
        at = self.start[:lanes] + t
        if self.size[lanes - 1] > t[-1, 0]:
            return at, None
        real = t < self.size[:lanes]
        return np.where(real, at, 0), real

    def begun(self, at: np.ndarray, real: np.ndarray | None) -> np.ndarray:
        begins = self.begins[at]
        return begins if real is None else begins & real


class Scorer:
    """Natural log probabilities of texts (each ends with symbol 0) that come slice by slice.

    When few lanes of a slice are left, their texts wait, as far as they were read, and go on beside the next slice's: the
    longest texts do not run by themselves.  Not more than WAITING symbols wait.
    """

    def __init__(self, p: dict[str, np.ndarray], layout: Layout):
        self.p, self.layout, self.class_of, self.output = p, layout, layout.class_of(), Output(p, layout)
        self.rows, self.u = (p["P"] + p["b"]).reshape(-1, STATE), _by_gate(p["U"])
        self.steps: dict[tuple[int, int], Steps] = {}
        self.waiting: list[tuple] = []  # of each: name, symbols left, symbol before them, state, sum so far

    def add(self, symbols: np.ndarray, lengths: np.ndarray, names: list, last: bool = False) -> dict:
        """Scores of the texts that ended, by name; with ``last`` of all that were added."""
        waited, self.waiting = self.waiting, []
        names = [w[0] for w in waited] + list(names)
        if not names:
            return {}
        lengths = np.append(np.array([len(w[1]) for w in waited], dtype=np.int64), lengths)
        lanes = Lanes(np.concatenate([w[1] for w in waited] + [symbols]), lengths, LANES, len(waited))
        logp = np.zeros(len(lanes.targets), dtype=np.float64)
        h = np.zeros((len(lanes.size), STATE), dtype=self.rows.dtype)
        for lane, texts in enumerate(lanes.texts):
            if texts[0] < len(waited):
                h[lane] = waited[texts[0]][3]
                lanes.inputs[lanes.start[lane]], lanes.begins[lanes.start[lane]] = waited[texts[0]][2], False
        t0, end = 0, int(lanes.size[0])
        while t0 < end:
            left = lanes.size - t0
            few = left[left > 0]
            if not last and len(few) < LANES // 2 and few.sum() <= WAITING:
                break
            at, real = lanes.window(t0, WINDOW)
            if at.shape not in self.steps:
                self.steps = {at.shape: Steps(*at.shape, self.rows.dtype, tape=False)}
            states = self.steps[at.shape].run(self.u, self.rows, lanes.inputs[at], lanes.begun(at, real), h[:at.shape[1]])
            h = states[-1]
            states, at = (states.reshape(-1, STATE), at.ravel()) if real is None else (states[real], at[real])
            logp[at] = log_probability(self.p, self.layout, self.class_of, states, lanes.targets[at], self.output)
            t0 += WINDOW
        found = {}
        for lane, texts in enumerate(lanes.texts):
            a = int(lanes.start[lane])
            read = a + min(t0, int(lanes.size[lane]))
            for i in texts:
                b, before = a + int(lengths[i]), waited[i][4] if i < len(waited) else 0.0
                if b <= read:
                    found[names[i]] = before + logp[a:b].sum()
                elif a < read:
                    self.waiting.append((names[i], lanes.targets[read:b].copy(), lanes.targets[read - 1], h[lane].copy(), before + logp[a:read].sum()))
                else:  # not begun
                    self.waiting.append((names[i], lanes.targets[a:b].copy(), 0, np.zeros(STATE, h.dtype), before))
                a = b
        return found


def text_scores(p: dict[str, np.ndarray], layout: Layout, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Natural log probability of every text (each ends with symbol 0)."""
    found = Scorer(p, layout).add(symbols, lengths, range(len(lengths)), last=True)
    return np.array([found[i] for i in range(len(lengths))])


def train(p: dict[str, np.ndarray], layout: Layout, symbols: np.ndarray, lengths: np.ndarray) -> dict[str, np.ndarray]:
    """One pass of truncated backpropagation with per-weight step sizes over whole texts."""
    output = Output(p, layout)
    p = {k: v.copy(order="C") for k, v in p.items() if k in ("P", "U", "b")} | output.views()  # updated in place
    rows = p["P"].reshape(-1, STATE)
    squares = {k: np.full_like(v, 1e-4) for k, v in p.items()}
    lanes = Lanes(symbols, lengths, TRAIN_LANES)
    class_of = layout.class_of()
    h = np.zeros((len(lanes.size), STATE), dtype=rows.dtype)
    last = int(lanes.size[0]) if len(lanes.size) else 0
    steps = None
    for t0 in range(0, last, TRAIN_WINDOW):
        at, real = lanes.window(t0, TRAIN_WINDOW)
        ids, begins = lanes.inputs[at], lanes.begun(at, real)
        if steps is None or steps.states.shape[:2] != at.shape:
            steps = Steps(*at.shape, rows.dtype, tape=True)
        states = steps.run(_by_gate(p["U"]), rows, ids, begins, h[:at.shape[1]], p["b"])
        h = states[-1]
        flat, targets = (states.reshape(-1, STATE), lanes.targets[at.ravel()]) if real is None else (states[real], lanes.targets[at[real]])
        _update(p, squares, _gradients(p, layout, class_of, (ids, begins, real, steps, output), [flat], targets))
        if t0 // TRAIN_WINDOW % LOOK == 0:
            output.look()
    return p


def _output_gradients(output: Output, layout, class_of, states, targets):
    """Gradients of a window's mean loss for C, c, W and w, and for the states."""
    classes = class_of[targets]
    order = np.argsort(classes, kind="stable")
    those, targets, classes = _with_one(states.take(order, axis=0)), targets[order], classes[order]
    scale = those.dtype.type(1.0 / len(those))
    # a softmax less one at the target, times scale: its exponentials less their sum at the target, times scale / sum,
    # which is put on the states' side of the products
    soft = output.logits(those, output.classes)
    np.exp(soft, out=soft)
    sums = soft @ np.ones(soft.shape[1], dtype=soft.dtype)
    soft.ravel()[np.arange(0, soft.size, soft.shape[1]) + classes] -= sums
    share = (scale / sums)[:, None]
    grad_c = (those * share).T @ soft
    d_those = soft @ output.classes[:STATE].T
    d_those *= share
    words = _WordSofts(output, layout, those, targets, classes)
    words.soft[words.targets] -= words.sums
    share = np.zeros((len(those), 1), dtype=those.dtype)
    share[words.rows, 0] = scale / words.sums
    shared, d_words, grad_w = those * share, np.zeros_like(d_those), np.zeros_like(output.words)
    for rows, which, part in words.parts:
        np.matmul(shared[rows].T, part, out=grad_w[:, which])
        np.matmul(part, output.words[:STATE, which].T, out=d_words[rows])
    d_words *= share
    d_those += d_words
    d_states = np.empty_like(d_those)
    d_states[order] = d_those
    return {"C": grad_c[:STATE], "c": grad_c[STATE], "W": grad_w[:STATE].T, "w": grad_w[STATE]}, d_states


def _gradients(p, layout, class_of, tape, states, targets):
    """Gradients of a window's mean loss; those of P as (symbols, their rows)."""
    s, (ids, begins, real, seen, output) = STATE, tape
    grad, d_states = _output_gradients(output, layout, class_of, states[0], targets)
    d = d_states.reshape(seen.states.shape) if real is None else np.zeros_like(seen.states)
    if real is not None:
        d[real] = d_states
    # what a state's gradient is multiplied by on its way to the gates and to the state before, for the whole window at
    # once; it takes the place of the gates, and their gradients then take its place
    g = seen.g
    np.reciprocal(g[:, :2], out=g[:, :2])
    z, r, m, kept = g.swapaxes(0, 1)
    rest = 1 - z
    to_cand = seen.cand * seen.cand
    np.subtract(1, to_cand, out=to_cand)
    to_cand *= rest
    rest *= z
    kept[:] = z
    kept[begins] = 0  # nothing of a state stays where a text begins
    np.subtract(seen.before, seen.cand, out=z)
    z *= rest
    np.multiply(to_cand, r, out=rest)
    np.subtract(1, r, out=r)
    r *= m
    r *= rest
    m[:] = rest
    starts = begins.any(axis=1).tolist()
    back = np.ascontiguousarray(p["U"].reshape(s, 3, s).transpose(1, 2, 0))
    ways = np.empty((3, *d.shape[1:]), dtype=d.dtype)
    way_z, way_r, way_m = ways
    later = list(d)
    for t in range(len(later) - 1, -1, -1):
        dh, (ways_on, d_gates, stays) = later[t], seen.back[t]
        np.multiply(ways_on, dh, ways_on)
        if t:
            np.matmul(d_gates, back, ways)
            if starts[t]:
                ways[:, begins[t]] = 0
            before = later[t - 1]
            np.add(before, stays, before)
            np.add(before, way_z, before)
            np.add(before, way_r, before)
            np.add(before, way_m, before)
    # by gate: the candidate's share of the state, the gates, the candidate
    d_in = np.empty((4, d.size // s, s), dtype=g.dtype)
    by_step = d_in.reshape(4, *d.shape)
    by_step[1:3] = g[:, :2].swapaxes(0, 1)
    by_step[0] = g[:, 2]
    np.multiply(d, to_cand, out=by_step[3])
    u = np.matmul(seen.before.reshape(-1, s).T, d_in[:3])
    grad["U"] = np.concatenate([u[1], u[2], u[0]], axis=1)
    grad["b"] = np.matmul(np.ones(d_in.shape[1], dtype=g.dtype), d_in[1:]).ravel()
    grad["P"] = _row_sums(ids.ravel() if real is None else ids[real], d_in[1:], None if real is None else np.flatnonzero(real))
    return grad


def _row_sums(ids: np.ndarray, d_in: np.ndarray, places: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The different ids and the sums of their rows, which lie at ``places`` (None: in order) of three arrays."""
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    n = np.diff(np.append(first, len(ids)))
    if places is not None:
        order = places[order]
    table, parts = d_in.reshape(-1, STATE), np.arange(3) * d_in.shape[1]
    out = table.take(order[first][:, None] + parts, axis=0).reshape(len(first), -1)
    several = n > 1
    if several.any():
        rows = table.take(order[np.repeat(several, n)][:, None] + parts, axis=0).reshape(-1, 3 * STATE)
        # rows are added up two numbers at a time, as parts of a complex number: half as many inner loops
        n = n[several]
        out[several] = np.add.reduceat(rows.view(np.result_type(rows.dtype, np.complex64)), np.cumsum(n) - n, axis=0).view(rows.dtype)
    return ids[first], out


def _update(p, squares, grad) -> None:
    rate = np.float32(LEARNING_RATE)
    for k, g in grad.items():
        if isinstance(g, tuple):
            ids, g = g
            size = squares[k].take(ids, axis=0)
            size += g * g
            squares[k][ids] = size
            np.sqrt(size, out=size)
            g *= rate
            g /= size
            np.subtract(p[k].take(ids, axis=0), g, out=g)
            p[k][ids] = g
        else:
            change = g * g
            squares[k] += change
            np.sqrt(squares[k], out=change)
            np.divide(g, change, out=change)
            change *= rate
            p[k] -= change
