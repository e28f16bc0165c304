"""Language-model scoring with a log-bilinear neural model trained by noise-contrastive estimation.

Tokens are the words of the ASCII-lower-cased text, then one end. Two tables are counted over all training
texts: every token's count (the base model is the count + 1/2, smoothed) and, from it, the ``n_classes`` most
frequent tokens, which with the end and a class for all others make the neural model's output. Its score
of class w after w1, w2 is (R[w1] C1 + R[w2] C2) . Q[w] + b[w]. Training maximises the NCE likelihood against
unigram noise in numpy: a warm start on a bounded sample (``WARM_DOCS`` texts of at most ``WARM_CHARS``
characters), then one pass over every training text, in tasks that start from the warm parameters and whose
parameters are averaged by tokens seen. Scoring is normalised exactly: the logits of a context are two rows
of precomputed products, and all contexts' sums over the classes are one product of matrices of exponentials.

Inside the class of all others a second log-bilinear network chooses among word classes whose number grows with
the square root of the distinct tokens: the next most frequent tokens each for itself, then the most frequent
endings of three bytes, then last bytes. Its contexts are these classes and the frequent tokens, so rare words
count as context too. Its softmax has two steps, a group of classes and a class in it, each normalised over
about the square root of the classes in batched products; it is trained by NCE in the same pass. A token's
score is P(other) P(class | other) times its base share in the class, with one share a class for unseen tokens.

Counts of the at most ``HEAD`` most frequent tokens go to the tasks; other tokens are few each, and are joined to the
count table by token, counted per document first. So memory does not grow with the vocabulary.

Defined results: a null or empty text is the end alone; without training tokens all counts are 0 and the
model is the base model; repeated rows are scored each. ``score`` gives all columns but ``text``; those named
like a result are replaced.
"""

import math
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm import common as C

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
END = b""  # no word is empty
HEAD, FLUSH = 200_000, 200_000
WARM_DOCS, WARM_CHARS, TRAIN_TASKS = 1_000, 20_000, 4_096
SLICE = 4_096  # parameters a row while tasks' networks are averaged
NEW = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]


def tokens(text) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return (text or "").encode().translate(LOWER).split()


def word_lists(texts: pa.Array):
    """(words as one binary array, words of each text) of string texts, as ``tokens`` gives them."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, starts = lists.flatten().cast(pa.binary()), np.asarray(lists.offsets)
    full = pc.greater(pc.binary_length(words), 0)  # white space at an end leaves an empty part
    before = np.concatenate([[0], np.cumsum(np.asarray(full.cast(pa.int64())))])
    return words.filter(full), np.diff(before[starts - starts[0]])


def _bytes(words: pa.Array) -> list[bytes]:
    return words.to_numpy(zero_copy_only=False).tolist()  # several times faster than to_pylist


def pieces(texts: pa.Array, most: int = 1 << 20):
    """``texts`` in runs of about ``most`` bytes, a text at least."""
    sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())) + 1)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + most, "right")))
        yield texts.slice(at, to - at)
        at = to


def token_counts(docs: DataFrame) -> DataFrame:
    """(token, n) over all texts, the end of each included."""

    def count(batches):
        held = Counter()
        for batch in batches:
            for texts in pieces(batch.column(0)):
                found = word_lists(texts)[0].value_counts()
                held.update(dict(zip(_bytes(found.field("values")), np.asarray(found.field("counts")).tolist())))
                held[END] += len(texts)
                if len(held) >= FLUSH:
                    yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], ["token", "n"])
                    held = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], ["token", "n"])

    return docs.select("text").mapInArrow(count, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


class Network:
    """Parameters of the log-bilinear model: class 0 is every other token, class 1 the end."""

    def __init__(self, noise: np.ndarray, dim: int = 24, seed: int = 7):
        rng, k = np.random.default_rng(seed), len(noise)
        self.noise, self.dim = noise, dim
        self.p = {"R": rng.normal(0, 0.1, (k, dim)), "Q": rng.normal(0, 0.1, (k, dim)), "b": np.log(noise),
                  "C1": np.eye(dim), "C2": np.eye(dim) * 0.5}
        self.p = {n: x.astype(np.float32) for n, x in self.p.items()}
        self.g2 = {n: np.full_like(x, 1e-4) for n, x in self.p.items()}
        self.cdf, self.log_noise = np.cumsum(noise) / noise.sum(), np.log(noise).astype(np.float32)

    def step(self, w2, w1, target, rng, lr=0.1, n_noise=48):
        """One AdaGrad step on a batch of (context, target)."""
        p, k = self.p, len(self.noise)
        noise = np.minimum(np.searchsorted(self.cdf, rng.random(n_noise)), k - 1)
        h = (p["R"] @ p["C1"]).take(w1, 0) + (p["R"] @ p["C2"]).take(w2, 0)
        qt, qn = p["Q"].take(target, 0), p["Q"][noise]
        shift = self.log_noise + np.float32(math.log(n_noise))
        e_t = _sigmoid(-np.einsum("ij,ij->i", h, qt), (shift - p["b"])[target])
        e_n = _sigmoid(np.dot(h, qn.T), (p["b"] - shift)[noise], -1)
        gh = e_t[:, None] * qt + e_n @ qn
        _move(self, np.concatenate([target, noise]), {"Q": np.concatenate([e_t[:, None] * h, e_n.T @ h]), "b": np.concatenate([e_t, e_n.sum(0)])}, len(target), lr)
        g1, g2 = np.zeros_like(p["R"]), np.zeros_like(p["R"])
        for w, g in ((w1, g1), (w2, g2)):
            rows, order, first = _by_row(w)
            g[rows] = np.add.reduceat(gh.take(order, 0), first, axis=0)
        _move(self, None, {"C1": p["R"].T @ g1, "C2": p["R"].T @ g2, "R": g1 @ p["C1"].T + g2 @ p["C2"].T}, len(target), lr)

    def train(self, documents, rng, finer: "Finer", batch=2048, chunk=1 << 16) -> int:
        """One pass over arrays of places, each a document with its end; returns the tokens seen."""
        held, size, seen = [], 0, 0

        def run():
            place = np.concatenate([np.concatenate([[1, 1], x]) for x in held])
            t = np.where(place < len(self.noise), place, 0)
            starts = np.cumsum([0] + [len(x) + 2 for x in held[:-1]])
            is_token = np.ones(len(t), bool)
            is_token[starts] = is_token[starts + 1] = False
            at = rng.permutation(np.flatnonzero(is_token))
            for i in range(0, len(at), batch):
                j = at[i:i + batch]
                self.step(t[j - 2], t[j - 1], t[j], rng)
            at = at[t[at] == 0]
            for i in range(0, len(at), batch):
                j = at[i:i + batch]
                finer.step(place[j - 2], place[j - 1], place[j] - len(self.noise), rng)

        for x in documents:
            held.append(x)
            size, seen = size + len(x), seen + len(x)
            if size >= chunk:
                run()
                held, size = [], 0
        if held:
            run()
        return seen

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[n].ravel() for n in sorted(self.p)]).astype(np.float32)

    def load(self, flat: np.ndarray):
        i = 0
        for n in sorted(self.p):
            x = self.p[n]
            self.p[n] = flat[i:i + x.size].astype(np.float32).reshape(x.shape)
            i += x.size
        return self


class Finer:
    """Word classes inside the class of all other tokens: a log-bilinear model whose softmax chooses a group of
    ``size`` neighbouring classes, then a class in it. Contexts are ``places`` many."""

    def __init__(self, noise: np.ndarray, places: int, dim: int = 24, seed: int = 11):
        rng, self.noise, self.places, self.dim = np.random.default_rng(seed), noise / noise.sum(), places, dim
        self.size = max(1, math.isqrt(len(noise)))
        self.group_noise = np.add.reduceat(self.noise, np.arange(0, len(noise), self.size))
        self.p = {"R1": rng.normal(0, 0.1, (places, dim)), "R2": rng.normal(0, 0.05, (places, dim)),
                  "Q": rng.normal(0, 0.1, (len(noise), dim)), "b": np.log(self.noise),
                  "S": rng.normal(0, 0.1, (len(self.group_noise), dim)), "e": np.log(self.group_noise)}
        self.p = {n: x.astype(np.float32) for n, x in self.p.items()}
        self.g2 = {n: np.full_like(x, 1e-4) for n, x in self.p.items()}
        self.drawn = [(np.cumsum(x), np.log(x).astype(np.float32)) for x in (self.noise, self.group_noise)]

    def step(self, w2, w1, target, rng, lr=0.1):
        """One AdaGrad step on a batch of (context, class): NCE of the class among all and of its group."""
        p, n = self.p, len(target)
        h, gh = p["R1"].take(w1, 0) + p["R2"].take(w2, 0), np.zeros((n, self.dim), np.float32)
        changed = [(w1, {"R1": gh}), (w2, {"R2": gh})]
        for (cdf, log_noise), q, b, t, k in ((self.drawn[0], "Q", "b", target, 32), (self.drawn[1], "S", "e", target // self.size, 8)):
            drawn = np.minimum(np.searchsorted(cdf, rng.random(k)), len(cdf) - 1)
            shift, qt, qn = log_noise + np.float32(math.log(k)), p[q].take(t, 0), p[q][drawn]
            e_t = _sigmoid(-np.einsum("ij,ij->i", h, qt), shift[t] - p[b][t])
            e_n = _sigmoid(np.dot(h, qn.T), p[b][drawn] - shift[drawn], -1)
            gh += e_t[:, None] * qt + e_n @ qn
            rows = np.concatenate([t, drawn])
            changed.append((rows, {q: np.concatenate([e_t[:, None] * h, e_n.T @ h]), b: np.concatenate([e_t, e_n.sum(0)])}))
        for rows, x in changed:
            _move(self, rows, x, n, lr)

    flat = Network.flat
    load = Network.load

    def log_p(self, w2, w1, target, chunk=1 << 14) -> np.ndarray:
        """Natural log P(class | context), normalised exactly in both steps."""
        p, out = self.p, np.empty(len(target))
        for i in range(0, len(target), chunk):
            t = target[i:i + chunk]
            h, group = p["R1"].take(w1[i:i + chunk], 0) + p["R2"].take(w2[i:i + chunk], 0), t // self.size
            found = _log_softmax(h @ p["S"].T + p["e"], group).astype(float)
            order = np.argsort(group, kind="stable")
            cuts = np.flatnonzero(np.diff(group[order])) + 1
            for rows in np.split(order, cuts):
                first = group[rows[0]] * self.size
                found[rows] += _log_softmax(h.take(rows, 0) @ p["Q"][first:first + self.size].T + p["b"][first:first + self.size], t[rows] - first)
            out[i:i + chunk] = found
        return out


def _by_row(rows):
    """(distinct rows, an order by row, where each row's run starts in it)."""
    rows = rows.astype(np.uint16) if rows.max(initial=0) < 1 << 16 else rows  # sorted by radix
    order = np.argsort(rows, kind="stable")
    found = rows[order]
    first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    return found[first].astype(np.int64), order, first


def _move(net, rows, gradients, n, lr):
    """AdaGrad with gradients summed by row (None: whole tables); only rows that a batch meets are touched, so a
    step's cost does not grow with the classes."""
    at = slice(None)
    if rows is not None:
        at, order, first = _by_row(rows)
        gradients = {name: np.add.reduceat(x.take(order, 0), first, axis=0) for name, x in gradients.items()}
    for name, x in gradients.items():
        x = x / np.float32(n)
        g2 = net.g2[name][at] + x * x
        net.g2[name][at] = g2
        net.p[name][at] += np.float32(lr) * x / np.sqrt(g2)


def _log_softmax(logits, chosen):
    logits -= logits.max(1, keepdims=True)
    found = logits[np.arange(len(chosen)), chosen]
    return found - np.log(np.exp(logits, out=logits) @ np.ones(logits.shape[1], logits.dtype))


def _sigmoid(x, more, sign=1):
    """``sign`` times the logistic function of x + more, in the memory of x."""
    x += more
    np.negative(x, out=x)
    with np.errstate(over="ignore"):  # 1 / infinity is 0
        np.exp(x, out=x)
    x += np.float32(1)
    return np.divide(np.float32(sign), x, out=x)


class Vocabulary:
    """The head of the count table. Place 0 is a token outside it, place 1 the end; ``rank`` gives the others'.
    Places below ``classes`` are the neural model's classes."""

    def __init__(self, head: list[tuple[bytes, int]], ends: int, total: int, distinct: int, n_classes: int):
        self.rank = {t: i + 2 for i, (t, _) in enumerate(head)}
        self.total, self.distinct, self.classes = total, distinct, min(n_classes, len(head)) + 2
        self.counts = np.array([0, ends] + [n for _, n in head])

    def base(self, n):
        return (n + 0.5) / (self.total + 0.5 * (self.distinct + 1))

    def refine(self, alone: int, endings: list[tuple[bytes, int, int]]):
        """Word classes of the tokens beyond ``classes``: the next ``alone`` of the head each for itself, then
        ``endings`` (bytes, occurrences, tokens), then any other token. A token's place is its class in contexts."""
        first = self.classes + alone
        self.ending = {e: first + i for i, (e, _, _) in enumerate(endings)}
        self.places = first + len(endings) + 1
        self.place = np.arange(len(self.counts))
        for t, i in self.rank.items():
            if i >= first:
                self.place[i] = self.class_of(t)
        mass = [*(self.counts[self.classes:first] + 0.5), *(n + 0.5 * k + 0.5 for _, n, k in endings), 0.5]
        self.finer_mass = np.array(mass) / (self.total + 0.5 * (self.distinct + 1))
        return self

    def class_of(self, token: bytes) -> int:
        return self.ending.get(token[-3:]) or self.ending.get(token[-1:]) or self.places - 1

    def find(self, words: list[bytes]):
        """(ranks, places) of the words and the end."""
        get = self.rank.get
        ranks = np.ones(len(words) + 1, np.int64)  # the end's
        ranks[:-1] = np.fromiter(map(get, words, repeat(0)), np.int64, len(words))
        places = self.place[ranks]
        tail = np.flatnonzero(ranks == 0)
        places[tail] = [self.class_of(words[i]) for i in tail.tolist()]
        return ranks, places

    def find_all(self, texts: pa.Array):
        """(ranks, places, where each text starts in them, words of the tokens outside the head, where they are) of all
        texts, an end after each; a distinct word is looked up once."""
        words, sizes = word_lists(texts)
        coded = words.dictionary_encode()
        distinct, code = _bytes(coded.dictionary), np.asarray(coded.indices)
        ranks, places = (x[:-1] for x in self.find(distinct))
        ends = np.cumsum(sizes + 1) - 1
        is_word = np.ones(len(code) + len(sizes), bool)
        is_word[ends] = False
        out = [np.ones(len(is_word), np.int64), np.full(len(is_word), self.place[1])]
        out[0][is_word], out[1][is_word] = ranks[code], places[code]
        outside = np.flatnonzero(ranks[code] == 0)
        return *out, ends - sizes, [distinct[i] for i in code[outside].tolist()], np.flatnonzero(is_word)[outside]


def ending_counts(counts: DataFrame, alone: list[bytes], most: int) -> list[tuple[bytes, int, int]]:
    """(ending, occurrences, tokens) over the counted tokens but those ``alone``: the ``most`` most frequent
    endings of three bytes (shorter tokens whole), and the last bytes of all other tokens."""
    spark = counts.sparkSession
    rest = counts.where(F.length("token") > 0)
    if alone:
        rest = rest.join(spark.createDataFrame([(bytearray(t),) for t in alone], "token binary"), "token", "left_anti")
    by_three = C.written(rest.groupBy(F.expr("substring(token, -3, 3)").alias("ending")).agg(F.sum("n").alias("n"), F.count("n").alias("k")), "endings")
    top = C.highest(by_three, F.col("n"), most)
    last = by_three.join(top.select("ending"), "ending", "left_anti").groupBy(F.expr("substring(ending, -1, 1)").alias("ending"))
    last = last.agg(F.sum("n").alias("n"), F.sum("k").alias("k"))  # at most 256
    tables = [{bytes(e): (n, k) for e, n, k in df.collect()} for df in (top, last)]
    for e in tables[0].keys() & tables[1].keys():  # a token of one byte is its own ending
        n, k = tables[1].pop(e)
        tables[0][e] = (tables[0][e][0] + n, tables[0][e][1] + k)
    return sorted(((e, n, k) for t in tables for e, (n, k) in t.items()), key=lambda x: (-x[1], x[0]))


def fit(docs: DataFrame, n_classes: int = 1_000, dim: int = 24):
    """(vocabulary, network, count table) from all of ``docs`` (text); the network of the word classes is
    ``vocabulary.finer``."""
    spark = docs.sparkSession
    counts = C.written(token_counts(docs), "tokens")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("n")).first()
    ends = getattr(counts.where(F.length("token") == 0).first(), "n", 0)
    top = C.highest(counts.where(F.length("token") > 0), F.col("n"), HEAD).toArrow()
    head = sorted(zip(top["token"].to_pylist(), top["n"].to_pylist()), key=lambda x: (-x[1], x[0]))
    vocabulary = Vocabulary(head, ends, total, distinct, n_classes)
    known = vocabulary.base(vocabulary.counts[1:vocabulary.classes])
    network = Network(np.concatenate([[max(1 - known.sum(), 1e-12)], known]), dim)
    root = math.isqrt(distinct)
    alone = max(0, min(2 * root, len(head) - n_classes))
    vocabulary.refine(alone, ending_counts(counts, [t for t, _ in head[:n_classes + alone]], root))
    finer = vocabulary.finer = Finer(vocabulary.finer_mass, vocabulary.places, dim)
    if not total:
        return vocabulary, network, counts
    held = spark.sparkContext.broadcast(vocabulary)

    def places(columns):
        for texts in (x for c in columns for x in pieces(c)):
            _, found, starts, _, _ = held.value.find_all(texts)
            yield from np.split(found, starts[1:])

    h = F.pmod(F.xxhash64("text"), F.lit(1 << 30))
    few = docs.select("text").where((h < int((1 << 30) * min(1.0, 4 * WARM_DOCS / max(1, ends)))) & (F.length("text") <= WARM_CHARS))
    network.train(places([pa.array([r.text for r in few.orderBy(h).limit(WARM_DOCS).collect()], pa.string())]), np.random.default_rng(1), finer)
    start = spark.sparkContext.broadcast((network.noise, network.dim, network.flat(), finer.flat()))

    def train(batches):
        from pyspark import TaskContext

        noise, dim, flat, finer_flat = start.value
        task, words = TaskContext.get().partitionId(), held.value
        net, fine = Network(noise, dim).load(flat), Finer(words.finer_mass, words.places, dim).load(finer_flat)
        seen = net.train(places(b.column(0) for b in batches), np.random.default_rng([2, task]), fine)
        if seen:
            x = np.concatenate([net.flat(), fine.flat()]) * np.float32(seen)
            parts = [x[i:i + SLICE].tobytes() for i in range(0, len(x), SLICE)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([seen] * len(parts), pa.int64()),
                                              pa.array(parts, pa.binary())], ["slice", "seen", "sum"])

    def add(batches):
        n, total = Counter(), {}
        for b in batches:
            for i, seen, raw in zip(*(c.to_pylist() for c in b.columns)):
                n[i] += seen
                total[i] = total.get(i, 0) + np.frombuffer(raw, np.float32).astype(float)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int32()), pa.array([(total[i] / n[i]).astype(np.float32).tobytes() for i in n], pa.binary())],
                                             ["slice", "mean"])

    trained = docs.select("text").coalesce(TRAIN_TASKS).mapInArrow(train, "slice int, seen long, sum binary")
    parts = C.written(trained.repartition(64, "slice").mapInArrow(add, "slice int, mean binary"), "network").collect()  # the parameters once
    if parts:
        flat = np.concatenate([np.frombuffer(bytes(r["mean"]), np.float32) for r in sorted(parts, key=lambda r: r["slice"])])
        cut = len(network.flat())
        network.load(flat[:cut])
        finer.load(flat[cut:])
    return vocabulary, network, counts


class Scorer:
    """Exact log10 probabilities of texts, up to what tokens outside the head add."""

    def __init__(self, vocabulary: Vocabulary, noise: np.ndarray, dim: int, flat: np.ndarray):
        p = {n: x.astype(float) for n, x in Network(noise, dim).load(flat).p.items()}
        self.vocabulary, self.finer, k, self.trained = vocabulary, vocabulary.finer, len(noise), vocabulary.total > 0
        self.base = np.log10(vocabulary.base(vocabulary.counts))
        self.classes, self.rest = k, math.log10(noise[0])
        self.a1, self.a2 = p["R"] @ p["C1"] @ p["Q"].T + p["b"], p["R"] @ p["C2"] @ p["Q"].T
        # the sum over classes of exp(a1 + a2) is a product of matrices, for all contexts at once
        top1, top2 = self.a1.max(1, keepdims=True), self.a2.max(1, keepdims=True)
        with np.errstate(divide="ignore"):
            self.log_z = (np.log(np.exp(self.a1 - top1) @ np.exp(self.a2 - top2).T) + top1 + top2.T).ravel()
        for c in np.flatnonzero(self.log_z < (top1 + top2.T).ravel() - 600):  # all products lost
            logits = self.a1[c // k] + self.a2[c % k]
            self.log_z[c] = logits.max() + np.log(np.exp(logits - logits.max()).sum())
        self.share = np.log10(vocabulary.finer_mass) - self.rest  # a word class's base share in the other tokens

    def __call__(self, text):
        """(tokens, known ones of the head, base score, score, Counter of the other tokens)."""
        return next(self.many([text]))

    def many(self, texts):
        """What a call gives for each text (a list or an Arrow array); the network runs over about a megabyte of text at once."""
        for part in pieces(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())):
            yield from self._batch(part)

    def _batch(self, texts):
        ranks, place, starts, outside, where = self.vocabulary.find_all(texts)
        p1 = np.concatenate([[1], place[:-1]])
        p2 = np.concatenate([[1], p1[:-1]])
        p2[starts] = 1  # the token before a start is the end of the text before
        w, w1, w2 = (np.where(x < self.classes, x, 0) for x in (place, p1, p2))
        log_p = (self.a1[w1, w] + self.a2[w2, w] - self.log_z[w1 * self.classes + w2]) / math.log(10)
        in_head = ranks > 0
        base = np.where(in_head, self.base[ranks], 0)
        at = np.flatnonzero(w == 0)
        target = place[at] - self.classes
        log_p[at] += base[at] - self.rest + self.finer.log_p(p2[at], p1[at], target) / math.log(10) - self.share[target]
        known = np.add.reduceat(in_head.astype(int), starts) if self.trained else np.zeros(len(texts), int)
        sizes = np.diff(np.append(starts, len(ranks)))
        cuts = np.searchsorted(where, np.append(starts, len(ranks))).tolist()
        totals = zip(sizes.tolist(), known.tolist(), np.add.reduceat(base, starts).tolist(), np.add.reduceat(log_p, starts).tolist(), cuts, cuts[1:])
        for n, k, b, p, first, last in totals:
            yield n, k, b, p, Counter(outside[first:last])


def score(docs: DataFrame, model) -> DataFrame:
    """``docs`` without text, with n_tokens, n_known, train_tokens, base_score and score."""
    vocabulary, network, counts = model
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast((vocabulary, network.noise, network.dim, network.flat()))
    keep = [c for c in C.keep_columns(docs, NEW) if c.lower() != "text"]
    row = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct(F.lit(0))
    slim = docs.select(row.alias("_row"), F.col("text").cast("string").alias("text"))
    schema = slim.select("_row", F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("n_tokens"), F.lit(0).cast("long").alias("n_known"),
                         F.lit(0.0).alias("base"), F.lit(0.0).alias("score"),
                         F.lit(None).cast("array<struct<token:binary,k:long>>").alias("tail")).schema

    def judge(batches):
        from pyspark import TaskContext

        scorer, key = Scorer(*held.value), TaskContext.get().partitionId() << 33
        tail_type = pa.list_(pa.struct([("token", pa.binary()), ("k", pa.int64())]))
        for batch in (b.slice(i, 512) for b in batches for i in range(0, b.num_rows, 512)):
            found = list(scorer.many(batch.column(1)))
            tail = pa.array([[{"token": t, "k": k} for t, k in x[4].items()] for x in found], tail_type)
            columns = [pa.array([x[i] for x in found], kind) for i, kind in enumerate([pa.int64(), pa.int64(), pa.float64(), pa.float64()])]
            keys = pa.array(range(key, key + len(found)), pa.int64())
            key += len(found)
            yield pa.RecordBatch.from_arrays([batch.column(0), keys, *columns, tail], ["_row", "key", "n_tokens", "n_known", "base", "score", "tail"])

    part = C.written(slim.mapInArrow(judge, schema), "scores")
    share = F.log10((F.coalesce("n", F.lit(0)) + 0.5) / F.lit(vocabulary.total + 0.5 * (vocabulary.distinct + 1)))
    other = part.select("key", F.inline("tail")).join(counts, "token", "left")
    other = other.groupBy("key").agg(F.sum(share * F.col("k")).alias("more"), F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("known"))
    out = part.drop("tail").join(other, "key", "left")
    more = F.coalesce("more", F.lit(0.0))
    columns = [F.col("_row")[c].alias(c) for c in keep]
    return out.select(*columns, "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
                      F.lit(int(vocabulary.total)).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"),
                      (F.col("score") + more).alias("score"))


def op5_query(spark, sf_dir):
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = C.fold(F.col("doc_id"), 5) == 1
    model = fit(docs.where(~held_out).select("text"))
    return score(docs.withColumn("held_out", held_out), model)
