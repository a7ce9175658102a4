"""Linear-chain conditional random field over the words of a text, in numpy: forward-backward, training and marginals for many texts at once."""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import xxhash

from quire.llm.looks import CYRILLIC, LATIN, odd, one_form, settled

#: A word, which a scanner may have put a figure into, a number, or a mark that may end a clause.
TOKENS = re.compile(r"[^\W_]+|[,;:.!?…()«»„“”\"\n—–]").findall
SIGN = re.compile(r"[\W\d_]+")
MARKS = ",;:.!?…()«»„“”\"\n—–"
CUT = re.compile(r"(?<=[^\W\d_])[-‐¬]\s*\n\s*(?=[^\W\d_])")
#: Words whose scores a worker keeps; beyond it starts afresh, with the same results.
KEPT = 300_000


def spoken(token: str) -> bool:
    """Whether a token is a word; a number separates words as a mark does."""
    return token[0].isalpha() or token[-1].isalpha()


def heading(line: str) -> bool:
    """A line of a few words that stands for itself: in capitals, or of names, or with a page number."""
    words = TOKENS(line)
    names = sum(w[0].isupper() for w in words)
    return not words or len(words) <= 10 and line[-1] not in "!?,;…»\".-¬‐" and (line.isupper() or 2 * names >= len(words) > 1 or names > 0 and (line[0].isdigit() or line[-1].isdigit()))


def tokens(text: str) -> list[str]:
    """Words and marks; words that a line end cuts are put together, headings and page numbers on lines of their own left out."""
    if odd(text):
        text = one_form(text)
    if "\n" in text:
        lines = [x for x in map(str.strip, text.split("\n")) if x]
        text = CUT.sub("", "\n".join(x for x in lines if not heading(x)) if len(lines) > 1 else text)
    return TOKENS(text)


def features(word: str, lexicon: dict[str, frozenset[str]], buckets: int) -> np.ndarray:
    """Hashed: the word, its affixes, letter pairs and triples, the lexicons it is in, its script and whether it has a capital."""
    w = settled(SIGN.sub("", word)).lower()
    t = f"<{w}>"
    # A name says little of the language, so a capital gives the word's own features another place.
    case = "A" if word[0].isupper() else "a"
    out = [f"{case}w{w}", f"{case}#", f"s{bool(CYRILLIC.search(w))}{bool(LATIN.search(w))}"]
    out += [f"{case}p{w[:k]}" for k in (1, 2, 3)] + [f"{case}x{w[-k:]}" for k in (1, 2, 3, 4)]
    out += [f"{case}n{t[k : k + n]}" for n in (2, 3) for k in range(len(t) - n + 1)]
    out += [f"l{name}" for name, words in lexicon.items() if w in words]
    return np.array([xxhash.xxh32_intdigest(x) % buckets for x in out], np.int64)


def pad(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of word numbers with their lengths; marks between words, number 0, become flags: (numbers from 1, after-a-mark flags)."""
    length = np.array([len(r) for r in rows])
    numbers = np.zeros((len(rows), max(1, int(length.max(initial=0)))), np.int64)
    numbers[np.arange(numbers.shape[1])[None, :] < length[:, None]] = np.concatenate(rows) if len(rows) else []
    return numbers, length


class Chain:
    """Weights: emissions for each hashed feature and label; two tables of transitions, within a clause and where one ends."""

    def __init__(self, labels: int, buckets: int = 1 << 15) -> None:
        self.labels, self.buckets = labels, buckets
        self.emit = np.zeros((buckets, labels))
        self.move = np.zeros((2, labels, labels))

    def forward_backward(self, scores: np.ndarray, after: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of each word's label, and the expected number of each transition; scores is (texts, words, labels), after says which table leads to a word."""
        b, t, k = scores.shape
        e = np.ascontiguousarray(scores.transpose(1, 0, 2))  # a word of all texts after the other
        e = np.exp(e - e.max(axis=2, keepdims=True))
        tables = np.exp(self.move).astype(e.dtype)
        fore, back = np.concatenate([*tables], axis=1), np.concatenate([x.T for x in tables], axis=1)
        after_t = np.ascontiguousarray(after.T)[:, :, None]
        inside = np.arange(t)[:, None] < length[None, :]
        a, z = np.empty_like(e), np.ones_like(e)
        a[0] = e[0] / e[0].sum(axis=1, keepdims=True)
        for i in range(1, t):
            p = a[i - 1] @ fore
            p = np.where(after_t[i], p[:, k:], p[:, :k]) * e[i]
            a[i] = p / p.sum(axis=1, keepdims=True)
        for i in range(t - 2, -1, -1):
            p = (e[i + 1] * z[i + 1]) @ back
            p = np.where(after_t[i + 1], p[:, k:], p[:, :k])
            z[i] = np.where(inside[i + 1, :, None], p / p.sum(axis=1, keepdims=True), e.dtype.type(1))
        m = a * z
        m /= m.sum(axis=2, keepdims=True)
        back_to = lambda x: x.transpose(1, 0, *range(2, x.ndim))
        return back_to(m), (back_to(a), back_to(z), back_to(e), tables, inside.T)

    def expected_moves(self, parts: tuple, after: np.ndarray) -> np.ndarray:
        a, z, e, tables, inside = parts
        out = np.zeros_like(tables)
        left, right, real = a[:, :-1], (e * z)[:, 1:], inside[:, 1:]
        for k in (0, 1):
            at = real & (after[:, 1:] == k)
            x, y = left[at], right[at]
            norm = np.einsum("ni,ij,nj->n", x, tables[k], y)
            out[k] = np.einsum("ni,nj,n->ij", x, y, 1 / np.maximum(norm, 1e-300)) * tables[k]
        return out

    def fit(self, words: list[np.ndarray], rows: list[np.ndarray], flags: list[np.ndarray], gold: list[np.ndarray], rounds: int = 40, rate: float = 0.15, decay: float = 2e-5) -> None:
        """words: the features of each word number from 1; rows, flags and gold: word numbers, after-a-mark flags and labels of each text. By Adam on the likelihood."""
        index = np.concatenate(words)
        starts = np.cumsum([0, *(len(w) for w in words)])[:-1]
        numbers, length = pad(rows)
        after, wanted = pad(flags)[0].astype(bool), pad(gold)[0]
        inside = np.arange(numbers.shape[1])[None, :] < length[:, None]
        ones = np.eye(self.labels)[wanted] * inside[:, :, None]
        seen_moves = np.zeros_like(self.move)
        both = inside[:, 1:]
        for k in (0, 1):
            at = both & (after[:, 1:] == k)
            np.add.at(seen_moves[k], (wanted[:, :-1][at], wanted[:, 1:][at]), 1)
        of, total = numbers[inside] - 1, float(inside.sum())
        moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (self.emit, self.move)]
        size = np.diff(np.append(starts, len(index)))
        for step in range(1, rounds + 1):
            scores = np.zeros((*numbers.shape, self.labels))
            scores[inside] = np.add.reduceat(self.emit[index], starts)[of]
            m, parts = self.forward_backward(scores, after, length)
            g = (ones - m)[inside]
            per_word = np.stack([np.bincount(of, g[:, k], len(words)) for k in range(self.labels)], axis=1)
            spread = np.repeat(per_word, size, axis=0)
            grads = (np.stack([np.bincount(index, spread[:, k], self.buckets) for k in range(self.labels)], axis=1), seen_moves - self.expected_moves(parts, after))
            for x, grad, (m1, m2) in zip((self.emit, self.move), grads, moments):
                grad = grad / total - decay * x
                m1 += 0.1 * (grad - m1)
                m2 += 0.01 * (grad * grad - m2)
                x += rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-9)


class Tagger:
    """Marginals of texts by a trained chain; scores of words are kept, as texts repeat them."""

    def __init__(self, trained: Chain, lexicon: dict[str, frozenset[str]]) -> None:
        self.chain, self.lexicon = trained, lexicon
        self._reset()

    def _reset(self) -> None:
        self.number: dict[str, int] = dict.fromkeys(MARKS, 0)
        self.scores = np.zeros((1, self.chain.labels), np.float32)

    def learn(self, new: set[str]) -> None:
        self.number.update((w, 0) for w in new if not spoken(w))
        new = [w for w in new if spoken(w)]
        first = len(self.scores)
        if not new:
            return
        add = np.array([self.chain.emit[features(w, self.lexicon, self.chain.buckets)].sum(axis=0) for w in new])
        self.number.update((w, first + k) for k, w in enumerate(new))
        self.scores = np.concatenate([self.scores, add.astype(np.float32)])

    def marginals(self, each: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(words x labels) marginals of all lists of tokens one after the other, and where each list's words begin, with the end."""
        if len(self.scores) > KEPT:
            self._reset()
        if new := set().union(*each).difference(self.number):
            self.learn(new)
        size = np.fromiter(map(len, each), np.int64, len(each))
        ids = np.fromiter(map(self.number.__getitem__, chain.from_iterable(each)), np.int64, int(size.sum()))
        word = ids > 0
        begins = np.append(0, np.cumsum(size))
        counted = np.append(0, np.cumsum(word))
        bounds = counted[begins]
        after = np.append(True, ~word[:-1])
        after[begins[:-1][begins[:-1] < len(after)]] = True
        ids, after = ids[word], after[word]
        length = np.diff(bounds)
        out = np.zeros((len(ids), self.chain.labels), np.float32)
        order = np.argsort(length, kind="stable")
        sorted_ = length[order]
        at = int(np.searchsorted(sorted_, 1))
        while at < len(order):
            # Texts of about one length go together, as many as keep the padded block small.
            n = int(sorted_[at])
            end = min(int(np.searchsorted(sorted_, n * 1.15 + 1, "right")), at + max(1, 60_000 // int(n * 1.15 + 1)))
            own, width = order[at:end], int(sorted_[end - 1])
            inside = np.arange(width)[None, :] < length[own][:, None]
            where = (bounds[own][:, None] + np.arange(width)[None, :])[inside]
            numbers, flags = np.zeros(inside.shape, np.int64), np.zeros(inside.shape, bool)
            numbers[inside], flags[inside] = ids[where], after[where]
            m, _ = self.chain.forward_backward(self.scores[numbers], flags, length[own])
            out[where] = m[inside]
            at = end
        return out, bounds


def train(texts: list[tuple[list[str], np.ndarray]], labels: int, lexicon: dict[str, frozenset[str]], rounds: int = 40, **given) -> Chain:
    """A chain from tokens with a label for each word."""
    out = Chain(labels)
    number: dict[str, int] = {}
    words, rows, flags, gold = [], [], [], []
    for toks, wanted in texts:
        row, flag, mark = [], [], True
        for t in toks:
            if spoken(t):
                if t not in number:
                    number[t] = len(number) + 1
                    words.append(features(t, lexicon, out.buckets))
                row.append(number[t])
                flag.append(mark)
                mark = False
            else:
                mark = True
        if row:
            rows.append(np.array(row))
            flags.append(np.array(flag, np.int64))
            gold.append(np.asarray(wanted))
    if rows:
        out.fit(words, rows, flags, gold, rounds, **given)
    return out
