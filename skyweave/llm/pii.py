"""Personal data: patterns, and a skip-chain conditional random field that carries labels to repeated and similar tokens.

The patterns give the base spans. The field's nodes are these spans, runs of digit groups parted by single spaces, dots, brackets
or hyphens that repeat a span's digits, and the other tokens of a text that hold a digit, `@` or `+`. Neighbours in
the text share chain potentials. Each node with the same digits or letters as a span, however they are written, a phone's digits
with a country code or leading zeros more or less, or the begin of an address past its `@`, shares a skip potential with that
span, and nodes of the same digits or letters share one with the next of their kind, spans or not. Labels follow from
loopy max-product messages, passed in alternating order until none moves; the labels of spans are given, so that edges to them only add to
a node's own points. A token that touches no base span gives a further span if the field labels it with a kind, whether or not the text has a base span.

The weights maximise the pseudo-likelihood of the labels of a bounded sample of documents (`TRAIN_DOCS`, of each the first `TRAIN_NODES` nodes, built
in the tasks). Labels are the patterns' own, with the evidence of a quarter of the nodes hidden at random; tokens that no pattern finds but that are
like a span are left out, as nothing says what they are. To them come mentions written anew (`_written_anew`): for each span two
of its own, joined to it, two that are joined to one another only, and four made up, joined to nothing, whose
label is none, as is that of dates, amounts and other plain numbers that stand alone or twice (`_plain`). So what joins and what a token looks like are both learned.

Null or empty text: no spans. Null doc_id, repeated rows: each row gets its own result. Empty table: no rows. Other columns are ignored by
the query and kept by the masking.
"""

from __future__ import annotations

import json
import random
import re
import zlib
from bisect import bisect_left, bisect_right
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
#: Documents, and nodes of each, that the field's weights are trained on at most, steps of training, their length and the weight of the
#: penalty on large weights.
TRAIN_DOCS, TRAIN_NODES, STEPS, RATE, PENALTY = 400, 1000, 150, 0.5, 1e-3
#: Rounds of messages before they are damped, and rounds beyond one for each node after which messages that still circle are taken as
#: they are.
UNDAMPED, CIRCLING = 6, 100
#: Digits of the longest span that groups can repeat with a country code more; as many again may be leading zeros.
LONGEST = 22
#: Spans of a text of which mentions are written anew for training, and words whose points a task remembers.
ANEW, REMEMBERED = 8, 10_000
SPANS = "struct<base:array<struct<kind:string,start:int,stop:int>>,spans:array<struct<kind:string,start:int,stop:int>>>"

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@+]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_RUN = re.compile(r"[+(]{0,2}[0-9](?:\)?[\x20.-]?\(?[0-9])*")
_GROUP = re.compile(r"[0-9]+")
_NOT_DIGIT = re.compile(r"[^0-9]")
_BEFORE, _AFTER = "<[{\"'", ".,;:!?>]}\"'"


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns, leftmost and non-overlapping in each kind, ordered by start and kind."""
    out = []
    done = 0
    if "@" in text:
        for m in _DOMAIN.finditer(text):
            at = m.start()
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                out.append((start, 0, m.end()))
                done = m.end()
    for m in _IP.finditer(text):
        if all(len(n := p.lstrip("0")) <= 3 and int(n or "0") <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 14 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return [(KINDS[k], a, b) for a, k, b in sorted(out)]


def _tokens(text: str) -> list[tuple[int, int]]:
    """Bounds of the words that hold a digit, `@` or `+`, without the marks around them."""
    out, at = [], 0
    while (m := _HINT.search(text, at)) is not None:
        start = m.start()
        while start > at and text[start - 1] not in " \t\n\x0b\x0c\r":
            start -= 1
        at = _TOKEN.match(text, start).end()
        word = text[start:at]
        bare = word.rstrip(_AFTER + ("" if "(" in word else ")"))
        out.append((start + len(bare) - len(bare.lstrip(_BEFORE + ("" if ")" in bare else "("))), start + len(bare)))
    return out


def _features(word: str) -> list[str]:
    digits = sum(map(str.isdigit, word))
    marks = "".join(c for c in "@+.-()/=:\"" if c in word)
    return [f"digits={min(digits, 20)}", f"groups={min(len(_GROUP.findall(word)), 6)}", f"marks={marks}", f"letters={min(sum(map(str.isalpha, word)), 8)}", f"first={'d' if word[0].isdigit() else word[0] if word[0] in '+(@' else 'x'}"]


def _key(word: str) -> str | None:
    """What similar tokens have in common: at least seven digits, or the letters and digits of an address-like token."""
    digits = _NOT_DIGIT.sub("", word)
    if len(digits) >= 7:
        return digits
    if "@" in word or word.count(".") >= 3:
        return re.sub(r"[^a-z0-9]", "", word.lower()) or None
    return None


def _address(word: str) -> tuple[str, str] | None:
    """Letters and digits before and after an address's `@`."""
    local, at, host = word.lower().partition("@")
    local, host = (re.sub(r"[^a-z0-9]", "", x) for x in (local, host))
    return (local, host) if at and local and host else None


class _Shown:
    """The spans that like mentions are joined to: for each key and label the first."""

    def __init__(self, words: list[str], labels: list[int]):
        self.same: dict[str, dict[int, int]] = defaultdict(dict)
        self.phones: dict[str, dict[int, int]] = defaultdict(dict)
        self.shorter: dict[str, dict[int, int]] = defaultdict(dict)
        self.hosts: dict[str, list[tuple[str, int]]] = defaultdict(list)  # ordered, so that the hosts of a begin stand together
        for i, (word, label) in enumerate(zip(words, labels, strict=True)):
            if not label:
                continue
            if (key := _key(word)) is not None:
                self.same[key].setdefault(label, i)
            if LABELS[label] == "phone":
                digits = _NOT_DIGIT.sub("", word).lstrip("0")
                self.phones[digits].setdefault(label, i)
                for cut in range(4):
                    if len(rest := digits[cut:].lstrip("0")) >= 7:
                        self.shorter[rest].setdefault(label, i)
            if LABELS[label] == "email" and (address := _address(word)) is not None:
                self.hosts[address[0]].append((address[1], i))
        for named in self.hosts.values():
            named.sort()

    def digits(self, digits: str, more: int) -> dict[int, int]:
        """Spans, by label, of the same digits (more = 0), or of a phone that has a country code more (-1) or less (1)."""
        if len(bare := digits.lstrip("0")) < 7:
            return self.same.get(digits, {}) if not more and len(digits) >= 7 else {}
        if not more:
            return self.same.get(digits) or self.phones.get(bare) or {}
        if more < 0:
            return self.shorter.get(bare, {})
        longer = (self.phones.get(rest) for cut in range(1, 4) if len(rest := bare[cut:].lstrip("0")) >= 7)
        return next(filter(None, longer), {})

    def like(self, word: str) -> dict[int, int]:
        """Spans, by label, that the word is like."""
        if (key := _key(word)) is not None and (found := self.same.get(key)):
            return found
        if "@" in word:
            if (address := _address(word)) is not None:
                named = self.hosts.get(address[0], [])
                at = bisect_left(named, (address[1], -1))
                if at < len(named) and named[at][0].startswith(address[1]):
                    return {LABELS.index("email"): named[at][1]}
            return {}
        digits = _NOT_DIGIT.sub("", word)
        return self.digits(digits, 0) or self.digits(digits, -1) or self.digits(digits, 1)


def _repeats(text: str, shown: _Shown) -> list[tuple[int, int]]:
    """Bounds of the groups of digits, parted in the text by spaces, that together are like a span: those of the same digits first,
    then those of a country code less or more, leftmost and longest first."""
    out = []
    if not shown.same:
        return out
    for m in _RUN.finditer(text):
        groups = [g.span() for g in _GROUP.finditer(text, m.start(), m.end())]
        if len(groups) == 1:
            continue
        used = [False] * len(groups)
        for more in (0, -1, 1):
            i = 0
            while i < len(groups):
                digits, stop = "", None
                for j in range(i, len(groups)):
                    digits += text[slice(*groups[j])]
                    if used[j] or len(digits) > 2 * LONGEST:
                        break
                    if shown.digits(digits, more):
                        stop = j
                if stop is None:
                    i += 1
                    continue
                used[i : stop + 1] = [True] * (stop + 1 - i)
                a = groups[i][0]
                while a > m.start() and text[a - 1] in "+(":
                    a -= 1
                if " " in text[a : groups[stop][1]]:
                    out.append((a, groups[stop][1]))
                i = stop + 1
    return sorted(out)


def _free(a: int, b: int, starts: list[int], ends: list[int]) -> bool:
    """Whether [a, b) touches none of the ordered, disjoint spans."""
    i = bisect_right(ends, a)
    return i == len(starts) or starts[i] >= b


def _graph(text: str, base: list[tuple[str, int, int]]):
    """Nodes (base spans, repeats and tokens that touch none), their texts, pattern labels, chain edges and skip edges."""
    nodes, reach = [], -1
    for kind, a, b in sorted(base, key=lambda s: s[1]):
        if a >= reach:
            nodes.append((a, b, LABELS.index(kind)))
        reach = max(reach, b)
    shown = _Shown([text[a:b] for a, b, _ in nodes], [k for _, _, k in nodes])
    starts, ends = [], []  # of the base spans, those that overlap taken together
    for _, a, b in sorted(base, key=lambda s: s[1]):
        if not ends or a >= ends[-1]:
            starts.append(a)
            ends.append(b)
        ends[-1] = max(ends[-1], b)
    repeats = [(a, b) for a, b in _repeats(text, shown) if _free(a, b, starts, ends)]
    nodes += [(a, b, 0) for a, b in repeats]
    more = [a for a, _ in repeats], [b for _, b in repeats]
    nodes += [(a, b, 0) for a, b in _tokens(text) if _free(a, b, starts, ends) and _free(a, b, *more)]
    nodes.sort()
    bounds = [(a, b) for a, b, _ in nodes]
    labels = np.array([k for _, _, k in nodes], int)
    words = [text[a:b] for a, b in bounds]
    chain = [(i, i + 1) for i in range(len(bounds) - 1) if bounds[i + 1][0] - bounds[i][1] <= 2]
    shown = _Shown(words, labels.tolist())
    last: dict[str, int] = {}
    skip = []
    for i, w in enumerate(words):
        joined = {j for j in shown.like(w).values() if j != i}
        if (k := _key(w)) is not None:
            if (j := last.get(k)) is not None:
                joined.add(j)
            last[k] = i
        skip += [(j, i) for j in sorted(joined)]
    return bounds, words, labels, chain, skip


def _decode(unary: np.ndarray, chain, skip, weights: dict) -> np.ndarray:
    """Labels by loopy max-product messages over chain and skip edges."""
    edges = sorted([(i, j, 0) for i, j in chain] + [(i, j, 1) for i, j in skip])
    tables = (weights["chain"], weights["skip"])
    into = np.zeros((len(edges), 2, len(LABELS)))  # messages to i and to j
    belief = unary.copy()
    order = list(range(len(edges)))
    for turn in range(len(unary) + CIRCLING if edges else 0):
        moved, step = False, 1.0 if turn < UNDAMPED else 0.5
        for e in order:
            i, j, which = edges[e]
            to_j = (belief[i] - into[e, 0])[:, None] + tables[which]
            to_i = (belief[j] - into[e, 1])[:, None] + tables[which].T
            for side, node, message in ((1, j, to_j.max(0)), (0, i, to_i.max(0))):
                message -= message.max()
                if np.abs(message - into[e, side]).max() > 1e-6:
                    change = step * (message - into[e, side])
                    belief[node] += change
                    into[e, side] += change
                    moved = True
        if not moved:
            break
        order.reverse()
    return belief.argmax(1)


def _unary(words, weights: dict) -> np.ndarray:
    """Points of words without evidence for each label."""
    known = weights.setdefault("known", {})
    if len(known) > REMEMBERED:
        known.clear()
    out = np.empty((len(words), len(LABELS)))
    for i, w in enumerate(words):
        if (points := known.get(w)) is None:
            points = weights["evidence"][0].copy()
            for f in _features(w):
                if (x := weights["word"].get(f)) is not None:
                    points += x
            if len(w) <= 64:
                known[w] = points
        out[i] = points
    return out


def decide(words: list[str], labels: np.ndarray, chain, skip, weights: dict) -> np.ndarray:
    """The labels of all nodes, those of spans as given. Messages are passed only among nodes that their edges could bring to another label than none."""
    free = np.flatnonzero(labels == 0)
    found = labels.copy()
    if not len(free):
        return found
    at = np.full(len(labels), -1)
    at[free] = np.arange(len(free))
    unary, reach, kept = _unary([words[i] for i in free], weights), np.zeros(len(free)), []
    for pairs, table in ((chain, weights["chain"]), (skip, weights["skip"])):
        i, j = np.array(pairs, int).reshape(-1, 2).T
        for a, b, t in ((i, j, table), (j, i, table.T)):  # a is given, b isn't
            given = (labels[a] > 0) & (labels[b] == 0)
            np.add.at(unary, at[b[given]], t[labels[a[given]]])
        both = (labels[i] == 0) & (labels[j] == 0)
        kept.append(np.stack([at[i[both]], at[j[both]]], 1))
        gain = max((table - table[:, :1]).max(), (table - table[:1]).max(), 0.0)
        np.add.at(reach, kept[-1].ravel(), gain)
    likely = unary[:, 1:].max(1) + reach > unary[:, 0]
    if not likely.any():
        return found
    near: dict[int, list[int]] = defaultdict(list)
    for pairs in kept:
        for i, j in pairs.tolist():
            near[i].append(j)
            near[j].append(i)
    stack = np.flatnonzero(likely).tolist()
    part = set(stack)
    while stack:
        more = [j for j in near[stack.pop()] if j not in part]
        part.update(more)
        stack += more
    own = sorted(part)
    place = {x: i for i, x in enumerate(own)}
    inside = [[(place[i], place[j]) for i, j in pairs.tolist() if i in place] for pairs in kept]
    found[free[own]] = _decode(unary[own], *inside, weights)
    return found


def _written_anew(kind: str, word: str, rng: random.Random, invented: bool = False) -> str:
    """A mention of a span's number or address in a form that no pattern finds, or one of the same form with other digits or letters."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    change = (lambda x: re.sub("[0-9]", lambda _: rng.choice("0123456789"), re.sub("[A-Za-z]", lambda _: rng.choice(letters), x))) if invented else (lambda x: x)
    digits = _NOT_DIGIT.sub("", word)
    if kind == "email":
        name, _, host = word.partition("@")
        return change(name) + "@" + change(host.split(".")[0])
    if kind == "phone":
        own = change(digits[-10:])
        return rng.choice([own, f"{own[:3]}-{own[3:6]}-{own[6:]}", f"{own[:3]}.{own[3:6]}.{own[6:]}", f"{own[:3]} {own[3:6]} {own[6:]}", change(digits), f"{digits[:-10]} {own[:3]} {own[3:6]} {own[6:]}", f"{digits[:-10]} ({own[:3]}) {own[3:6]} {own[6:]}", f"00{change(digits)}"]).strip()
    mark = rng.choice("-/" if kind == "ip" else "./")
    return change(word.replace(".", mark) if kind == "ip" else mark.join(digits[i : i + 4] for i in range(0, len(digits), 4)))


def _plain(rng: random.Random) -> str:
    """A date, time, amount, version or number such as texts repeat without naming anyone."""
    n = lambda a, b: rng.randint(a, b)
    day = f"{n(1900, 2099)}-{n(1, 12):02}-{n(1, 28):02}"
    amount = f"{n(1, 10 ** n(4, 9)):,}"
    return rng.choice([day, f"{n(1, 28)}.{n(1, 12)}.{n(1900, 2099)}", f"{day}T{n(0, 23):02}:{n(0, 59):02}", f"{n(0, 23)}:{n(0, 59):02}", amount, f"{amount}.{n(0, 99):02}", f"v{n(0, 20)}.{n(0, 20)}.{n(0, 20)}", str(n(0, 10 ** n(1, 24))), f"{n(0, 16**40):x}"[: n(6, 40)], f"{n(0, 100)}%", f"no.{n(1, 10**6)}-{n(1, 9)}"])


def _graphs(column: pa.Array) -> pa.Array:
    """The first nodes of each text for training, and mentions written anew: features, labels, 2 where a node's evidence is shown at times, 1 where never and 0 where
    the node has no known label, edges, and pairs that are joined to each other only, as JSON."""
    out = []
    for value in column:
        text = value.as_py() or ""
        _, words, labels, chain, skip = _graph(text, base_spans(text))
        n, rng = min(len(words), TRAIN_NODES), random.Random(zlib.crc32(text.encode()))
        words, labels = words[:n], labels[:n].tolist()
        chain, skip = ([e for e in edges if max(e) < n] for edges in (chain, skip))
        unknown = {b for i, j in skip for a, b in ((i, j), (j, i)) if labels[a] and not labels[b]}
        sure, pairs = [0 if i in unknown else 2 for i in range(n)], []
        for i in [i for i in range(n) if labels[i]][:ANEW]:
            kind, at = LABELS[labels[i]], len(words)
            plain = [_plain(rng) for _ in range(4)]
            words += [_written_anew(kind, words[i], rng) for _ in range(4)] + [_written_anew(kind, words[i], rng, invented=True) for _ in range(4)] + plain + plain[:2]
            labels += [labels[i]] * 4 + [0] * 10
            sure += [1] * 14
            skip += [(i, at), (i, at + 1)]
            pairs += [(at + 2, at + 3), (at + 8, at + 12), (at + 9, at + 13)]
        out.append(json.dumps([[_features(w) for w in words], labels, sure, chain, skip, pairs]) if words else None)
    return pa.array(out, pa.string())


def fit(graphs: list, steps: int = STEPS) -> dict:
    """Weights that maximise the pseudo-likelihood: each node's label given the labels of those it shares an edge with, and both labels of a pair at once."""
    names: dict[str, int] = {}
    rows, labels, told, pairs, edges, at = [], [], [], [], {"chain": [], "skip": []}, 0
    for features, own, sure, chain, skip, joined in graphs:
        rows += [[names.setdefault(f, len(names)) for f in fs] for fs in features]
        labels += own
        told += sure
        pairs += [(i + at, j + at) for i, j in joined]
        for kind, found in (("chain", chain), ("skip", skip)):
            edges[kind] += [(i + at, j + at) for i, j in found if sure[i] and sure[j]]
        at += len(own)
    rows, y, k = np.array(rows, int).reshape(-1, len(_features("0"))), np.array(labels, int), len(LABELS)
    left, right = np.array(pairs, int).reshape(-1, 2).T
    ends = {kind: np.array(e, int).reshape(-1, 2).T for kind, e in edges.items()}
    w = {"word": np.zeros((len(names), k)), "evidence": np.zeros((k, k)), "chain": np.zeros((k, k)), "skip": np.zeros((k, k))}
    size = {name: np.full_like(x, 1e-6) for name, x in w.items()}
    rng, truth, told = np.random.default_rng(11), np.eye(k)[y], np.array(told, int)
    for _ in range(steps if at else 0):
        evidence = np.where((rng.random(at) < 0.25) | (told < 2), 0, y)
        points = w["word"][rows].sum(1) + w["evidence"][evidence]
        for kind, (i, j) in ends.items():
            np.add.at(points, i, w[kind][:, y[j]].T)
            np.add.at(points, j, w[kind][y[i]])
        one, other = points[left], points[right]
        both = one[:, :, None] + other[:, None, :] + w["skip"]
        both = np.exp(both - both.max((1, 2), keepdims=True))
        both /= both.sum((1, 2), keepdims=True)
        points -= points.max(1, keepdims=True)
        off = (truth - np.exp(points) / np.exp(points).sum(1, keepdims=True)) * (told > 0)[:, None]
        off[left], off[right] = truth[left] - both.sum(2), truth[right] - both.sum(1)
        up = {name: -PENALTY * at * x for name, x in w.items()}
        np.add.at(up["skip"], (y[left], y[right]), 1)
        up["skip"] -= both.sum(0)
        np.add.at(up["word"], rows, off[:, None, :])
        np.add.at(up["evidence"], evidence, off)
        for kind, (i, j) in ends.items():
            np.add.at(up[kind].T, y[j], off[i])
            np.add.at(up[kind], y[i], off[j])
        for name, x in w.items():
            size[name] += up[name] ** 2
            x += RATE * up[name] / np.sqrt(size[name])
        w["skip"] = (w["skip"] + w["skip"].T) / 2  # like nodes have no order
    return {name: w[name] for name in ("evidence", "chain", "skip")} | {"word": {f: w["word"][i] for f, i in names.items()}}


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: int = TRAIN_DOCS) -> dict:
    """The field's weights, from at most `limit` documents that hold a digit, `@` or `+`, the first by hash of id and text."""
    likely = docs.where(F.col(text).rlike("[0-9@+]")).select(F.col(text).alias("text"), F.xxhash64(F.col(doc_id).cast("string"), F.col(text)).alias("h"))
    picked = [r["h"] for r in likely.select("h").distinct().orderBy("h").limit(limit).collect()]
    chosen = likely.where(F.col("h") <= picked[-1]) if picked else likely.limit(0)
    rows = chosen.select("h", F.arrow_udf(_graphs, "string")("text").alias("g")).where("g is not null").dropDuplicates(["h"]).collect()
    return fit([json.loads(r["g"]) for r in sorted(rows, key=lambda r: r["h"])])


def find_spans(text: str, weights: dict) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and all spans: the base ones and those that the field adds."""
    if _HINT.search(text) is None:
        return [], []
    base = base_spans(text)
    bounds, words, labels, chain, skip = _graph(text, base)
    found = decide(words, labels, chain, skip, weights)
    more = [(LABELS[found[i]], *bounds[i]) for i in np.flatnonzero((found > 0) & (labels == 0)).tolist()]
    order = {k: i for i, k in enumerate(KINDS)}
    return base, sorted(base + more, key=lambda s: (s[1], order[s[0]], s[2]))


def _spans(column: pa.Array, weights: dict) -> pa.Array:
    rows = []
    for value in column:
        base, spans = find_spans(value.as_py() or "", weights)
        rows.append({n: [{"kind": k, "start": a, "stop": b} for k, a, b in s] for n, s in (("base", base), ("spans", spans))})
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
    return pa.array(rows, pa.struct([("base", span), ("spans", span)]))


def spans_of(text: Column, weights: dict) -> Column:
    """Struct of base spans and all spans, in code points."""
    return F.arrow_udf(lambda t: _spans(t, weights), SPANS)(text)


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, counts of base spans by kind, the digest of base spans, and all spans."""
    found = docs.select(F.col(doc_id), spans_of(F.col(text), train(docs, doc_id, text)).alias("f")).select(doc_id, "f.*")
    said = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
    of_kind = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    counts = [of_kind(k).alias(f"n_{k}") for k in KINDS]
    return found.select(doc_id, *counts, F.sha2(said(F.col("base")), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))


def _masked_text(text: str | None, weights: dict) -> str | None:
    if text is None or not (spans := find_spans(text, weights)[1]):
        return text
    parts, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            parts += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join([*parts, text[at:]])


def _masked(column: pa.Array, weights: dict) -> pa.Array:
    """Some texts at a time, so that a batch isn't held as Python strings, too."""
    some = (column.slice(i, 200) for i in range(0, len(column), 200))
    done = [pa.array([_masked_text(v.as_py(), weights) for v in part], pa.string()) for part in some]
    return pa.concat_arrays(done) if done else pa.array([], pa.string())


def mask(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with each span replaced by `<kind>`; overlapping spans give one mark. Null text stays null."""
    weights = train(docs, doc_id, text)
    return docs.withColumn(text, F.arrow_udf(lambda t: _masked(t, weights), "string")(F.col(text)))
