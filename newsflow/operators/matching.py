"""Dictionary matches over Arrow arrays of tokens, for ``coding.code_documents``."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

STRINGS = pa.list_(pa.string())
# Documents matched at a time, whatever the size of an Arrow batch.
AT_ONCE = 256
# Per sentence, as in ``schemas.CODED_SENTENCE``.
MATCHES = pa.struct([
    ("nouns", STRINGS), ("noun_coding", STRINGS), ("verbs", pa.string()), ("verb_coding", pa.string()),
    ("events", pa.list_(STRINGS)),
])
MATCHES_DDL = (
    "array<struct<nouns:array<string>,noun_coding:array<string>,verbs:string,verb_coding:string,"
    "events:array<array<string>>>>"
)


class Phrases:
    """A dictionary as a prefix tree: every beginning of a phrase is a node, 0 is the empty one."""

    def __init__(self, entries: list[tuple[str, str | None, str | None]]):
        words, nodes = {}, {"": 0}
        steps = {}
        for phrase, _, _ in entries:
            node = 0
            for depth, word in enumerate(parts := phrase.split(" "), 1):
                step = node, words.setdefault(word, len(words))
                node = steps[step] = nodes.setdefault(" ".join(parts[:depth]), len(nodes))
        self.words = pa.array(list(words), pa.string())
        self.phrases = pa.array(list(nodes), pa.string())
        codes = {phrase: (actor, verb) for phrase, actor, verb in entries}
        self.actors, self.verbs = (
            pa.array([codes.get(phrase, (None, None))[k] for phrase in nodes], pa.string()) for k in (0, 1))
        self.is_actor, self.is_verb = (c.is_valid().to_numpy(zero_copy_only=False) for c in (self.actors, self.verbs))
        # A step is looked up by node and word; the last key is larger than any.
        n = max(1, len(words))
        keys = np.array([node * n + word for node, word in steps] + [np.iinfo(np.int64).max], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.targets = keys[order], np.array([*steps.values(), 0], dtype=np.int64)[order]

    def longest(self, tokens: pa.Array, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Token positions that may begin a phrase, their sentences, and the nodes of the longest actor and verb there, 0 for none.

        Sentence ``i`` has the tokens from ``bounds[i]`` up to ``bounds[i + 1]``.
        """
        word = pc.index_in(tokens, value_set=self.words).fill_null(-1).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(word >= 0)
        sentence = np.searchsorted(bounds, starts, side="right") - 1
        ends = bounds[sentence + 1]
        actor, verb = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        alive, node, depth = np.arange(len(starts)), np.zeros(len(starts), np.int64), 0
        while len(alive):
            at = starts[alive] + depth
            inside = at < ends[alive]
            alive, node, at = alive[inside], node[inside], at[inside]
            key = node * max(1, len(self.words)) + word[at]
            found = np.searchsorted(self.keys, key)
            known = (word[at] >= 0) & (self.keys[found] == key)
            alive, node, depth = alive[known], self.targets[found[known]], depth + 1
            is_actor, is_verb = self.is_actor[node], self.is_verb[node]
            actor[alive[is_actor]], verb[alive[is_verb]] = node[is_actor], node[is_verb]
        return starts, sentence, actor, verb

    def match(self, documents: pa.Array) -> pa.Array:
        """``match_some`` on slices, so that the arrays beside a batch stay small."""
        return pa.concat_arrays(
            [self.match_some(documents.slice(i, AT_ONCE)) for i in range(0, max(1, len(documents)), AT_ONCE)])

    def match_some(self, documents: pa.Array) -> pa.Array:
        """Documents as arrays of sentences as arrays of tokens to arrays of ``MATCHES``; NULL stays NULL.

        The first actor of a sentence acts on the last one through every verb that starts between them.
        """
        sentences = documents.flatten()
        tokens = sentences.flatten()
        lengths = pc.list_value_length(sentences).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        bounds = _offsets(lengths)
        starts, sentence, actor, verb = self.longest(tokens, bounds)
        n = len(lengths)

        is_actor, is_verb = actor > 0, verb > 0
        actors, verbs = actor[is_actor], verb[is_verb]
        actor_of, verb_of = sentence[is_actor], sentence[is_verb]
        actor_bounds = _offsets(np.bincount(actor_of, minlength=n))
        nouns, coding = (_lists(actor_bounds, values.take(pa.array(actors))) for values in (self.phrases, self.actors))
        some = np.flatnonzero(np.diff(actor_bounds))
        first, last = np.zeros(n, np.int64), np.zeros(n, np.int64)
        first[some], last[some] = actor_bounds[some], actor_bounds[some + 1] - 1

        verb_bounds = _offsets(np.bincount(verb_of, minlength=n))
        with_verb = np.diff(verb_bounds) > 0
        leading = np.zeros(n, np.int64)
        leading[with_verb] = verbs[verb_bounds[:-1][with_verb]]
        leading = pa.array(leading, mask=~with_verb)
        verb_text, verb_code = (pc.fill_null(values.take(leading), "") for values in (self.phrases, self.verbs))

        # Between fewer than two actors lies nothing.
        acted = np.diff(actor_bounds)[verb_of] > 1
        source, target, kept, of = first[verb_of[acted]], last[verb_of[acted]], verbs[acted], verb_of[acted]
        at, actor_at = starts[is_verb][acted], starts[is_actor]
        between = (at > actor_at[source]) & (at < actor_at[target])
        source, target, kept, of = source[between], target[between], kept[between], of[between]
        codes = pa.concat_arrays([self.actors.take(pa.array(actors)), self.verbs.take(pa.array(kept))])
        triple = np.column_stack([source, target, len(actors) + np.arange(len(kept))]).ravel()
        events = _lists(_offsets(np.full(len(kept), 3)), codes.take(pa.array(triple)))
        counts = np.bincount(of, minlength=n)
        events = _lists(_offsets(counts), events, counts == 0)

        matches = pa.StructArray.from_arrays([nouns, coding, verb_text, verb_code, events], fields=list(MATCHES))
        held = pc.list_value_length(documents).fill_null(0).to_numpy(zero_copy_only=False)
        return _lists(_offsets(held), matches, documents.is_null().to_numpy(zero_copy_only=False))


def _offsets(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def _lists(offsets: np.ndarray, values: pa.Array, missing: np.ndarray | None = None) -> pa.Array:
    mask = None if missing is None else pa.array(missing.astype(bool))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values, mask=mask)
