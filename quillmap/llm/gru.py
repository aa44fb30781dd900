"""A gated recurrent language model in numpy: class-factored softmax, truncated backpropagation, state carried on.

Token ids: 0 is the end (and what stands before the first word), 1 to words - 1 the most frequent words, then one id for
each class of other words. Listed words form classes in order of frequency, each of an equal share of the square roots of
the frequencies: frequent words stand in small classes, so that most steps have few outputs. The model gives P(class) and,
for listed words, P(word | class). What an unlisted word has of its class is left to the caller.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

#: Outputs beyond it are cut to it, in training and scoring alike: the softmax needs no largest output then.
MOST = 60.0
#: Rows whose outputs are computed at once, texts whose states move side by side when scoring, states held for their outputs,
#: and weights moved at once: as many as stay in a core's cache.
ROWS, ABREAST, STATES, MOVED = 2048, 512, 1 << 15, 1 << 14


def _sigmoid_of_double(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-2x)), in place."""
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


class Adam:
    """Adam over a model's arrays; of the input vectors only the rows that a window has are moved.

    m and v lack their factors 0.1 and 0.01, which the step makes good.
    """

    def __init__(self, p: dict[str, np.ndarray]):
        self.p, self.done = p, 0
        self.m, self.v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))

    def step(self, grad: dict[str, np.ndarray], rows: np.ndarray, rate: float) -> None:
        """grad["x"] has the gradients of these rows only. The gradients are overwritten."""
        self.done += 1
        clip = min(1.0, 5.0 / (np.sqrt(sum(float(np.vdot(g, g)) for g in grad.values())) + 1e-9))
        far = ((1 - 0.99**self.done) / 0.01) ** 0.5
        now, least = 0.1 * far * rate / (1 - 0.9**self.done), 1e-6 * far
        for k, g in grad.items():
            if k == "x":
                p, m, v = (a[k][rows] for a in (self.p, self.m, self.v))
                self._move(p, m, v, g, clip, now, least)
                self.p[k][rows], self.m[k][rows], self.v[k][rows] = p, m, v
            else:
                p, m, v, g = (a.reshape(-1) for a in (self.p[k], self.m[k], self.v[k], g))
                for lo in range(0, len(g), MOVED):
                    at = slice(lo, lo + MOVED)
                    self._move(p[at], m[at], v[at], g[at], clip, now, least)

    @staticmethod
    def _move(p: np.ndarray, m: np.ndarray, v: np.ndarray, g: np.ndarray, clip: float, now: float, least: float) -> None:
        if clip < 1:
            g *= clip
        m *= 0.9
        m += g
        g *= g
        v *= 0.99
        v += g
        np.sqrt(v, out=g)
        g += least
        np.divide(m, g, out=g)
        g *= now
        p -= g


class GRU:
    def __init__(self, freq: np.ndarray, rest: np.ndarray, hidden: int = 32, width: int = 32, seed: int = 4):
        """freq: how often each listed id was seen in the corpus; rest: how often each class of others was; width: a class's mean size."""
        rng = np.random.default_rng(seed)
        self.words, self.rest, self.hidden = len(freq), len(rest), hidden
        listed = -(-self.words // width)
        f = np.asarray(freq, float) + 0.5
        root = np.cumsum(np.sqrt(f))
        own = np.minimum((root - np.sqrt(f) / 2) * (listed / root[-1]), listed - 1).astype(np.int64)
        _, first, own = np.unique(np.maximum.accumulate(own), return_index=True, return_inverse=True)  # a class without words is none
        self.listed, self.first = len(first), np.append(first, self.words)
        self.own = np.concatenate([own, np.arange(self.rest) + self.listed])
        n_class = self.listed + self.rest
        small = lambda *s: (rng.standard_normal(s) * 0.08).astype(np.float32)
        per = np.add.reduceat(f, first)
        mass = np.concatenate([per, np.asarray(rest, float) + 0.5])
        self.p = {
            "x": small(self.words + self.rest, hidden), "i": (rng.standard_normal((hidden, 3 * hidden)) * hidden**-0.5).astype(np.float32), "u": small(hidden, 3 * hidden),
            "c": small(hidden, n_class), "cb": np.log(mass / mass.sum()).astype(np.float32),
            "w": small(self.words, hidden), "wb": np.log(f / per[own]).astype(np.float32),
        }

    def _given(self) -> tuple[np.ndarray, np.ndarray]:
        """i and u with columns as rows; those of the gates halved, as _sigmoid_of_double takes them."""
        half = np.repeat(np.array([0.5, 0.5, 1], self.p["u"].dtype), self.hidden)[:, None]
        return self.p["i"].T * half, self.p["u"].T * half

    def _step(self, a: np.ndarray, b: np.ndarray, h: np.ndarray, new: np.ndarray) -> None:
        """The next state into new. A column is a text: a has what the words give to gates and candidate, b what the state h
        gives. a is overwritten with the gates and the candidate, the first rows of b with what is passing."""
        k = self.hidden
        g, n, t = a[: 2 * k], a[2 * k :], b[:k]
        g += b[: 2 * k]
        _sigmoid_of_double(g)
        np.multiply(g[:k], b[2 * k :], out=t)
        n += t
        np.tanh(n, out=n)
        np.subtract(h, n, out=new)
        new *= g[k:]
        new += n

    def step(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        """The next state and, side by side, both gates and the candidate: a row is a text."""
        i, u = self._given()
        a, new = i @ self.p["x"][x].T, np.empty(h.T.shape, i.dtype)
        self._step(a, u @ h.T, h.T, new)
        return new.T, a.T

    def _within(self, most: float = 1.0) -> bool:
        """Whether no output can be beyond MOST, so that none has to be cut; most: the largest entry of a state (1: none was given)."""
        longest = lambda a: float(np.einsum("ij,ij->i", a, a).max(initial=0)) ** 0.5
        w, b = max(longest(self.p["w"]), longest(self.p["c"].T)), max(float(np.abs(self.p[b]).max(initial=0)) for b in ("wb", "cb"))
        return most * self.hidden**0.5 * w + b < 0.99 * MOST

    def _classes(self, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int, int]]]:
        """Of targets: their classes, their order by class, and of each listed class (first word, end, first place in this order, end)."""
        own = self.own.take(target)
        order = np.argsort(own.astype(np.int16) if self.listed + self.rest < 1 << 15 else own, kind="stable")
        cuts = np.searchsorted(own.take(order), np.arange(self.listed + 1)).tolist()
        first = self.first.tolist()
        return own, order, list(zip(first, first[1:], cuts, cuts[1:], strict=False))

    def log_probs(self, h: np.ndarray, target: np.ndarray, within: bool = False) -> np.ndarray:
        """Natural logarithms of P(class) P(word | class), or of P(class) for unlisted words. within: no output is beyond MOST."""
        own, order, classes = self._classes(target)
        out, places = np.empty(len(h), h.dtype), np.arange(ROWS)

        def log_softmax(h: np.ndarray, w: np.ndarray, bias: np.ndarray, at: np.ndarray) -> np.ndarray:
            s = h @ w
            if within:  # biases are factors of the sum
                got, factor = s[places[: len(s)], at] + bias.take(at), np.exp(bias)
            else:
                s += bias
                np.clip(s, -MOST, MOST, out=s)
                got, factor = s[places[: len(s)], at], np.ones(s.shape[1], s.dtype)
            np.exp(s, out=s)
            got -= np.log(s @ factor)
            return got

        for lo in range(0, len(h), ROWS):
            at = slice(lo, lo + ROWS)
            out[at] = log_softmax(h[at], self.p["c"], self.p["cb"], own[at])
        for lo, hi, a, b in classes:
            for x in range(a, b if hi - lo > 1 else a, ROWS):
                at = order[x : min(x + ROWS, b)]
                out[at] += log_softmax(h.take(at, axis=0), self.p["w"][lo:hi].T, self.p["wb"][lo:hi], target.take(at) - lo)
        return out

    def score(self, texts: list[np.ndarray], window: int = STATES) -> np.ndarray:
        """The log probability (natural) of each whole text's ids, the end included.

        Texts of similar length move side by side; once there are `window` states their outputs are computed.
        """
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        total = np.zeros(len(texts))
        (i, u), within = self._given(), self._within()
        room, kind = max(window, ABREAST), i.dtype
        states, wanted, owner, used = np.empty((room, self.hidden), kind), np.empty(room, np.int64), np.empty(room, np.int64), 0

        def flush() -> None:
            got = self.log_probs(states[:used], wanted[:used], within)
            np.add(total, np.bincount(owner[:used], got, len(total)), out=total)

        for lo in range(0, len(order), ABREAST):
            which = np.array(order[lo : lo + ABREAST])
            lengths = np.array([len(texts[j]) + 1 for j in which])
            flat = np.concatenate([np.append(texts[j], 0) for j in which])
            begin = np.cumsum(lengths) - lengths
            live = len(which) - np.searchsorted(lengths[::-1], np.arange(lengths[0]), side="right")  # longest first: they go on
            h, last, m = np.zeros((self.hidden, len(which)), kind), np.zeros(len(which), np.int64), len(which)
            a, b, new = (np.empty((rows * self.hidden, m), kind) for rows in (3, 3, 1))
            for t, now in enumerate(live.tolist()):
                if now < m:
                    m = now
                    h, last, begin, which = h[:, :m].copy(), last[:m], begin[:m], which[:m]
                    a, b, new = (np.empty((rows * self.hidden, m), kind) for rows in (3, 3, 1))
                np.matmul(i, self.p["x"].take(last, axis=0).T, out=a)
                np.matmul(u, h, out=b)
                self._step(a, b, h, new)
                h, new = new, h
                last = flat[begin + t]
                if used + m > room:
                    flush()
                    used = 0
                states[used : used + m], wanted[used : used + m], owner[used : used + m] = h.T, last, which
                used += m
        if used:
            flush()
        return total

    def fit(self, texts: list[np.ndarray], streams: int = 64, window: int = 24, epochs: int = 2, rate: float = 4e-3) -> GRU:
        """Truncated backpropagation: texts end to end in parallel streams; the state goes on from window to window."""
        flat = np.concatenate([np.append(t, 0) for t in texts]) if texts else np.empty(0, np.int64)
        streams = max(1, min(streams, len(flat) // (2 * window)))
        steps = len(flat) // streams
        if steps < 2:
            return self
        y = flat[: streams * steps].reshape(streams, steps)
        x = np.concatenate([np.zeros((streams, 1), np.int64), y[:, :-1]], 1)
        adam = Adam(self.p)
        total = epochs * (steps // window + 1)
        for _ in range(epochs):
            self._windows(x, y, window, adam, lambda _: rate * (1 - 0.9 * (adam.done + 1) / total))
        return self

    def _windows(self, x: np.ndarray, y: np.ndarray, window: int, adam: Adam, rate) -> None:
        """Windows of parallel streams one after another; rate(targets of the window) is the step's."""
        h, room = np.zeros((len(x), self.hidden), np.float32), {}
        for lo in range(0, x.shape[1], window):
            part = x[:, lo : lo + window]
            grad, rows, h = self._window(part, y[:, lo : lo + window], h, room)
            adam.step(grad, rows, rate(part.size))

    def train(self, texts: Iterable[np.ndarray], rate: float, streams: int = 256, window: int = 24, held: int = 1 << 20) -> int:
        """One pass over any number of texts, about `held` tokens in memory at a time; every token is a target once.

        Returns how many there were. Few tokens are dealt to few streams; windows of few targets take shorter steps.
        """
        adam, parts, size, seen = Adam(self.p), [], 0, 0
        slower = lambda n: rate * min(1.0, n / (64 * window)) ** 0.5

        def run(last: bool) -> np.ndarray:
            nonlocal seen
            flat = np.concatenate(parts)
            while len(flat):
                n = max(1, min(streams, len(flat) // (64 * window)))
                steps = len(flat) // n
                y = flat[: n * steps].reshape(n, steps)
                self._windows(np.concatenate([np.zeros((n, 1), np.int64), y[:, :-1]], 1), y, window, adam, slower)
                seen += n * steps
                flat = flat[n * steps :]
                if not last:
                    break
            return flat

        for t in texts:
            parts.append(np.append(t, 0))
            size += len(parts[-1])
            if size >= held:
                parts = [run(False)]
                size = len(parts[0])
        if size:
            run(True)
        return seen

    def _window(self, x: np.ndarray, y: np.ndarray, h: np.ndarray, room: dict[str, np.ndarray] | None = None) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
        """Gradients of the mean loss over a window (of "x" for the rows returned), and the state after it.

        A text's first step starts from no state. Inside, a column of a step is a text, so that gates are blocks of memory.
        room: arrays that the windows of one pass share.
        """
        n, steps, k = len(x), x.shape[1], self.hidden
        kind, room = self.p["u"].dtype, {} if room is None else room

        def space(name: str, *shape: int) -> np.ndarray:
            if name not in room or room[name].shape != shape or room[name].dtype != kind:
                room[name] = np.empty(shape, kind)
            return room[name]

        g = {a: np.zeros_like(b) for a, b in self.p.items() if a in ("i", "u", "cb")} | {a: space("g" + a, *self.p[a].shape) for a in ("w", "wb")}
        start = (x.T != 0).astype(kind)
        before, gave, acts = space("before", steps, k, n), space("gave", steps, k, n), space("acts", steps, 3 * k, n)
        passing, new = space("passing", 3 * k, n), space("new", k, n)
        ids = x.T.reshape(-1)
        words, flat = space("words", steps, n, k), space("flat", steps * n, k)
        self.p["x"].take(ids, axis=0, out=words.reshape(steps * n, k), mode="clip")
        i, u = self._given()
        state = np.ascontiguousarray(h.T)
        for t in range(steps):
            np.multiply(state, start[t], out=before[t])
            np.matmul(i, words[t].T, out=acts[t])
            np.matmul(u, before[t], out=passing)
            gave[t] = passing[2 * k :]
            self._step(acts[t], passing, before[t], new)
            flat[t * n : (t + 1) * n] = new.T
            state = new
        h = new.T.copy()
        target = y.T.reshape(-1)
        own, order, classes = self._classes(target)
        own, target, dh = own.take(order), target.take(order), flat
        flat = flat.take(order, axis=0, out=space("sorted", steps * n, k), mode="clip")
        scale, places, within = 1 / len(target), np.arange(ROWS), self._within(max(1.0, float(np.abs(before[0]).max())))

        def outputs(at: slice, w: np.ndarray, bias: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, ...]:
            """(e, s, z) of states: e's columns times s are the gradients for w, times z for the bias; and the states' own."""
            s = flat[at]
            e = s @ w.T
            e += bias
            if not within:
                np.clip(e, -MOST, MOST, out=e)
            np.exp(e, out=e)
            z = e @ np.ones(e.shape[1], kind)
            e[places[: len(e)], of] -= z
            np.divide(scale, z, out=z)
            moved = e @ w
            moved *= z[:, None]
            return e, s * z[:, None], z, moved

        ranked, c, gc = space("ranked", steps * n, k), self.p["c"].T.copy(), 0
        for lo in range(0, len(flat), ROWS):
            at = slice(lo, lo + ROWS)
            e, s, z, ranked[at] = outputs(at, c, self.p["cb"], own[at])
            gc += e.T @ s
            g["cb"] += z @ e
        g["c"] = gc.T.copy()
        for lo, hi, a, b in classes:
            w, gw, gb = self.p["w"][lo:hi], g["w"][lo:hi], g["wb"][lo:hi]
            if a == b or hi - lo == 1:
                gw[:], gb[:] = 0, 0
                continue
            for x in range(a, b, ROWS):
                at = slice(x, min(x + ROWS, b))
                e, s, z, moved = outputs(at, w, self.p["wb"][lo:hi], target[at] - lo)
                ranked[at] += moved
                if x == a:
                    np.matmul(e.T, s, out=gw)
                    np.matmul(z, e, out=gb)
                else:
                    gw += e.T @ s
                    gb += z @ e
        dh[order] = ranked
        # gradients of what enters: candidate, reset gate, update gate, and by the state, times the reset gate, the candidate again
        enter, rest, d, back, t = space("enter", 4 * k, n), space("rest", 2 * k, n), space("d", k, n), np.zeros((k, n), kind), space("t", k, n)
        rest_r, rest_z = rest[:k], rest[k:]  # 1 - r, 1 - z
        to_cand, to_r, to_z, by_state = (enter[j * k : (j + 1) * k] for j in range(4))
        moved, made = enter[: 3 * k], enter[k:]
        u = self.p["u"]
        i = np.concatenate([self.p["i"][:, 2 * k :], self.p["i"][:, : 2 * k]], 1).T.copy()
        gi = np.zeros((k, 3 * k), kind)
        for at in range(steps - 1, -1, -1):
            r, z, cand = (acts[at, j * k : (j + 1) * k] for j in range(3))
            np.add(back, dh[at * n : (at + 1) * n].T, out=d)
            np.subtract(1, acts[at, : 2 * k], out=rest)
            rest_z *= d
            np.multiply(cand, cand, out=t)
            t *= rest_z
            np.subtract(rest_z, t, out=to_cand)
            np.subtract(before[at], cand, out=t)
            t *= z
            np.multiply(rest_z, t, out=to_z)
            np.multiply(to_cand, r, out=by_state)
            rest_r *= gave[at]
            np.multiply(by_state, rest_r, out=to_r)
            g["u"] += before[at] @ made.T
            gi += words[at].T @ moved.T
            np.matmul(moved.T, i, out=words[at])  # from here on the gradients of what the words are
            np.matmul(u, made, out=back)
            d *= z
            back += d
            back *= start[at]
        g["i"][:, : 2 * k], g["i"][:, 2 * k :] = gi[:, k:], gi[:, :k]
        order = np.argsort(ids.astype(np.uint16) if self.words + self.rest < 1 << 16 else ids, kind="stable")
        ranked = ids[order]
        first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
        g["x"] = np.add.reduceat(words.reshape(steps * n, k).take(order, axis=0, out=flat, mode="clip"), first)
        return g, ranked[first], h
