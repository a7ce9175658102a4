"""Averaged perceptrons: one that edits the characters of a word, one that chooses among a few operations for a place of a text."""

from __future__ import annotations

import random
from collections import defaultdict

from quire.llm.looks import CYRILLIC

#: The noise process: what a scanner reads, and what may have stood there, by script; each is as likely as another. Fixed values.
READ_AS = {
    "cyrillic": "0:о 1:і|л 3:з|э 4:ч 6:б 8:в @:а ь1:ы ьi:ы ьі:ы ы:ьі н:и|п|к и:н|п|й п:л|н|и л:п|д|я ш:щ|м|ит щ:ш м:ш|н т:г|м|ш г:т|r е:с|о с:е|о о:с|е|а а:о|е|я х:к|ж к:х|н|в в:б|в з:э|в э:з б:в|6 "
    "ц:п|ч|ш ч:ц|у у:ч д:л|я ж:х я:л|а р:п|ф ф:р го:ю ю:го|іо ii:п і:ї|1 ї:і є:с|е ё:е|й й:и ъ:ь ь:ъ|в ск:ж lо:ю іо:ю !:і $:ѕ |:і|л".split(),
    "latin": "0:o 1:l|i 3:e 4:a 5:s 6:b 8:b 9:g @:a |:l|i !:i|l $:s rn:m m:rn|in|nn ri:n n:ri|u|h|r u:n|v|ii c:e|o|ß e:c|o o:c|e|a a:o|s f:t|s t:f|l|r l:t|i|1 i:l|j|t vv:w w:vv cl:d d:cl h:b|n|li b:h|6 q:g g:q "
    "y:v v:y|u r:t|n s:a|5 ii:u|n j:i z:2 li:h ß:b é:e|c è:e ä:a ö:o ü:u à:a â:a ê:e".split(),
}


def confusions(script: str) -> list[tuple[str, str]]:
    """(read, meant) of the noise process."""
    out = []
    for x in READ_AS[script]:
        read, _, meant = x.partition(":") if not x.startswith("|") else ("|", ":", x[2:])
        out += [(read, m) for m in meant.split("|") if m]
    return out


def script_of(word: str) -> str:
    return "cyrillic" if CYRILLIC.search(word) else "latin"


def outputs(read: str, meant: str) -> list[str]:
    """What each character read becomes: replaced, deleted (an empty string), or replaced with another inserted (two characters)."""
    n = len(read)
    return [meant[k : k + 1] for k in range(n - 1)] + [meant[n - 1 :]]


class WordEditor:
    """For each character of a word the output it becomes: itself (keep), another (replace), none (delete), two (replace and insert).

    Trained on words corrupted by the noise process; the features of a place are the characters around it and how often clean words have
    the three that an output makes with its neighbours.
    """

    def __init__(self, script: str) -> None:
        self.script = script
        self.choices: dict[str, list[str]] = {}
        for read, meant in confusions(script):
            for c, o in zip(read, outputs(read, meant)):
                own = self.choices.setdefault(c, [c])
                if o not in own:
                    own.append(o)
        self.weights: dict[str, float] = {}
        self.triples: dict[str, int] = {}

    def _places(self, word: str) -> list[tuple[int, list[list[str]]]]:
        """Each place with a choice, and the features of each of its outputs."""
        w, get, out = f"^^{word}$$", self.triples.get, []
        for i, c in enumerate(word):
            if (own := self.choices.get(c)) is None:
                continue
            a, b, y, z = w[i], w[i + 1], w[i + 3], w[i + 4]
            around = (f"0{c}", f"1{b}{c}", f"2{c}{y}", f"3{b}{c}{y}", f"4{a}{b}{c}", f"5{c}{y}{z}")
            feats = []
            for o in own:
                t = f"{b}{o}{y}" if o else f"{b}{y}"
                n, m, k = get(t[:3], 0), get(f"{a}{b}{o}"[:3], 0), get(f"{o}{y}{z}"[:3], 0)
                tail = ("k" if o == c else "e") + f"{min(3, n)}", ("k" if o == c else "e") + f"l{min(2, m)}{min(2, k)}"
                feats.append([f"{x}>{o}" for x in around] + [*tail])
            out.append((i, feats))
        return out

    def margins(self, word: str) -> list[tuple[float, int, str]]:
        """(score of an edit less that of keeping, place, output), the likeliest first."""
        get, out = self.weights.get, []
        for i, feats in self._places(word):
            s = [sum(get(x, 0.0) for x in f) for f in feats]
            out += [(s[k] - s[0], i, o) for k, o in enumerate(self.choices[word[i]]) if k]
        return sorted(out, reverse=True)

    def candidates(self, word: str, singles: int = 24, pairs: int = 8) -> list[tuple[str, float]]:
        """Words that this one may have been, with the sum of the margins, the likeliest first: one edit, two, and edits of two characters read as one."""
        edits = self.margins(word)
        found: dict[str, float] = {}

        def add(chosen: list[tuple[float, int, str]]) -> None:
            chars = list(word)
            for _, i, o in chosen:
                chars[i] = o
            found.setdefault("".join(chars), sum(m for m, _, _ in chosen))

        for e in edits[:singles]:
            add([e])
        best = edits[: pairs * 2]
        at = {(i, o): m for m, i, o in edits}
        for read, meant in confusions(self.script):  # several characters that were read for one
            for i in (m for m in range(len(word) - len(read) + 1) if len(read) > 1 and word.startswith(read, m)):
                own = [(at.get((i + k, o), 0.0), i + k, o) for k, o in enumerate(outputs(read, meant)) if o != word[i + k]]
                add(own)
                for e in best[:pairs]:
                    if not i <= e[1] < i + len(read):
                        add([*own, e])
        if len(word) > 4:
            for x, e in enumerate(best):
                for f in best[x + 1 :]:
                    if e[1] != f[1]:
                        add([e, f])
        found.pop(word, None)
        return sorted(found.items(), key=lambda x: -x[1])

    def train(self, words: list[str], rounds: int = 4, seed: int = 3) -> None:
        rng = random.Random(seed)
        for w in words:
            t = f"^^{w}$$"
            for k in range(len(t) - 2):
                self.triples[t[k : k + 3]] = self.triples.get(t[k : k + 3], 0) + 1
        noise = confusions(self.script)
        by_meant: dict[str, list[str]] = defaultdict(list)
        for read, meant in noise:
            by_meant[meant].append(read)
        data = []
        for w in words:
            data.append((w, list(w)))
            sites = [(i, m, r) for m, reads in by_meant.items() for i in range(len(w) - len(m) + 1) if w.startswith(m, i) for r in reads]
            if sites:
                i, meant, read = rng.choice(sites)
                data.append((w[:i] + read + w[i + len(meant) :], [*w[:i], *outputs(read, meant), *w[i + len(meant) :]]))
        weights, total, when, clock = self.weights, defaultdict(float), {}, 0
        for _ in range(rounds):
            rng.shuffle(data)
            for word, gold in data:
                for i, feats in self._places(word):
                    clock += 1
                    own = self.choices[word[i]]
                    if gold[i] not in own:
                        continue
                    want = own.index(gold[i])
                    s = [sum(weights.get(x, 0.0) for x in f) for f in feats]
                    got = max(range(len(s)), key=lambda k: s[k] - (k == want) * 1e-9)
                    if got != want:
                        for k, step in ((want, 1.0), (got, -1.0)):
                            for x in feats[k]:
                                total[x] += (clock - when.get(x, 0)) * weights.get(x, 0.0)
                                when[x] = clock
                                weights[x] = weights.get(x, 0.0) + step
        self.weights = {x: (total[x] + (clock - when[x]) * w) / max(1, clock) for x, w in weights.items()}


class Chooser:
    """An averaged perceptron over named features with a weight for each operation."""

    def __init__(self, operations: tuple[str, ...]) -> None:
        self.operations = operations
        self.weights: dict[str, list[float]] = {}

    def scores(self, features: list[str]) -> list[float]:
        out = [0.0] * len(self.operations)
        for f in features:
            if (w := self.weights.get(f)) is not None:
                for k, x in enumerate(w):
                    out[k] += x
        return out

    def choose(self, features: list[str]) -> str:
        s = self.scores(features)
        return self.operations[s.index(max(s))]

    def train(self, data: list[tuple[list[str], str]], rounds: int = 6, seed: int = 3) -> None:
        rng, n = random.Random(seed), len(self.operations)
        total: dict[str, list[float]] = {}
        data, clock = list(data), 0
        for _ in range(rounds):
            rng.shuffle(data)
            for features, wanted in data:
                clock += 1
                want, s = self.operations.index(wanted), self.scores(features)
                got = s.index(max(s))
                if got != want:
                    for f in features:
                        w, t = self.weights.setdefault(f, [0.0] * n), total.setdefault(f, [0.0] * n)
                        w[want] += 1
                        w[got] -= 1
                        t[want] += clock
                        t[got] -= clock
        # The mean of all states: each step counts from when it was made.
        self.weights = {f: [x - total[f][k] / max(1, clock) for k, x in enumerate(w)] for f, w in self.weights.items()}
