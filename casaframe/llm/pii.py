"""Personal data: base patterns, and contextual extraction by bootstrapping.

Base entities (email, ip, card, phone) are found by fixed patterns.  They,
and secrets that show by their form (long hexadecimal strings, access key
ids), are the seeds.  Each seed gives the lexical pattern to its left: a cue
(a word with ``:``, ``=``, ``#`` or an opening quote) or else the two words
before it.  Patterns that enough different seeds share are then matched
against the whole corpus, which gives the graph of patterns and the
instances they extract:

* a pattern's confidence is the summed belief in its distinct instances,
  over those and all places where it is followed by no identifier at all;
* the belief in an unknown instance is the noisy-or of the confidences of
  the patterns that extract it; a seed is believed.

Spark iterates the two over the graph (one row per pattern and instance);
patterns of high confidence then extract unseen identifiers, each of its
pattern's kind, wherever no seed stands.  The spans are the seeds and these.

A pattern needs ``MIN_SUPPORT`` different seeds in a table of any size.  The
patterns that have them are counted; tasks get at most ``MAX_PATTERNS`` of
them, and more are matched in further passes over the corpus.  The trusted
ones go to every task of the last pass, however many they are.

Defined results: a null text is empty; empty texts have no spans; repeated
rows are scanned each on their own; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casaframe.llm.common import MAX_BROADCAST_ROWS, append_columns, written

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
MIN_SUPPORT = 5      # different seeds that must share a pattern
PIECE = 1024         # characters of a long value that are hashed at once
MAX_PATTERNS = 100_000  # patterns that one pass over the corpus matches
ROUNDS = 3
CONFIDENCE = 0.8

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# possessive runs and the look-behind change no match; they keep long runs of digits linear
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
SECRET = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-f]{16,}+|AKIA[0-9A-Z]{16})(?![0-9A-Za-z])")
CUE = r"([^\W\d_]\w{0,31})[ \t]{0,2}([:=#][ \t]{0,2}[\"'(\[]?|[ \t][\"'(\[])"
CUE_BEFORE = re.compile(CUE + r"\Z")
CUE_ANYWHERE = re.compile(r"(?<!\w)" + CUE + r"(?=[^\s\"'(\[])")
WORDS_BEFORE = re.compile(r"(?<!\S)([^\W\d_]{1,32}) ([^\W\d_]{1,32}) \Z")
VALUE = re.compile(r"[^\s\"'()\[\]<>,;]{4,}+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ ends one run of local-part characters: no search starts inside a run."""
    last, at = 0, text.find("@")
    while at >= 0:
        left = at
        while left > last and text[left - 1] in LOCAL:
            left -= 1
        m = DOMAIN.match(text, at + 1) if left < at else None
        if m:
            yield left, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def _luhn(digits: str) -> bool:
    total = sum(int(c) for c in digits[-1::-2])
    total += sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base entities, by kind and start, in code points."""
    if not text:
        return []
    out = [("email", s, e) for s, e in _emails(text)] if "@" in text else []
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(map(_small, m.groups()))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text)
                if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    return out


class Spans:
    """Places of a text as disjoint intervals in order, looked up by bisection."""

    def __init__(self, spans=()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for s, e in sorted(spans):
            if self.ends and s < self.ends[-1]:
                self.ends[-1] = max(e, self.ends[-1])
            else:
                self.append(s, e)

    def append(self, s: int, e: int) -> None:
        """``s`` is not before any interval's end."""
        self.starts.append(s)
        self.ends.append(e)

    def meets(self, s: int, e: int) -> bool:
        k = bisect_left(self.starts, e) - 1
        return k >= 0 and self.ends[k] > s


def seeds(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Base entities and secrets that show by their form and overlap none of them."""
    taken = Spans((s, e) for _, s, e in base)
    return base + [("secret", *m.span()) for m in SECRET.finditer(text) if not taken.meets(*m.span())]


def _cue(word: str, mark: str) -> str:
    return word.lower() + "".join(mark.split())


def context(text: str, start: int) -> str | None:
    """The lexical pattern that ends where an entity starts."""
    left = text[max(0, start - 72):start]
    m = CUE_BEFORE.search(left)
    if m:
        return _cue(*m.groups())
    m = WORDS_BEFORE.search(left)
    return f" {m[1].lower()} {m[2].lower()} " if m else None


def _md5(value: str) -> str:
    return hashlib.md5(value.encode("utf-8", "surrogatepass")).hexdigest()


def _digest(value: str) -> str:
    """MD5 of a value; of a long one, chained over pieces counted from its end."""
    return Values(value).digest(0, len(value)) if len(value) >= PIECE else _md5(value)


class Values:
    """The identifiers that stand behind cues of a text.

    All cues within one run of value characters have values with the same
    end, so what a run needs is found once, however many cues it holds.
    """

    def __init__(self, text: str):
        self.text, self.lo, self.hi = text, 0, -1

    def _run(self, at: int) -> None:
        m = VALUE.match(self.text, at)
        self.lo, self.hi = at, m.end() if m else -1
        if not m:
            return
        end = self.hi
        while end > at and self.text[end - 1] in ".:!?":
            end -= 1
        self.end, self.tails = end, []
        self.at_sign = self.text.rfind("@", at, end)
        digits, k = [], end - 1
        while k >= at and len(digits) < 4:
            if self.text[k].isdigit():
                digits.append(k)
            k -= 1
        self.last, self.fourth = (digits or [-1])[0], digits[3] if len(digits) == 4 else -1

    def span(self, at: int) -> tuple[int, int] | None:
        """The value that starts at ``at``: at least 4 characters, no punctuation at its end."""
        if not self.lo <= at < self.hi:
            self._run(at)
        return (at, self.end) if self.hi - at >= 4 and self.end - at >= 4 else None

    def numeric(self, at: int) -> bool:
        """Whether the value at ``at`` holds a digit or an @."""
        return max(self.last, self.at_sign) >= at

    def identifier(self, at: int) -> bool:
        return max(self.fourth, self.at_sign) >= at

    def digest(self, at: int, end: int) -> str:
        first = end - (end - at) // PIECE * PIECE
        tails = self.tails if self.hi >= 0 and end == self.end else []
        for k in range(end - (len(tails) + 1) * PIECE, first - 1, -PIECE):
            tails.append(_md5(self.text[k:k + PIECE] + (tails[-1] if tails else "")))
        n = (end - first) // PIECE
        return _md5(self.text[at:first] + (tails[n - 1] if n else ""))


class Matcher:
    """Places of the given patterns in a text: (pattern, where its value starts)."""

    def __init__(self, patterns: list[str]):
        import ahocorasick
        self.cues = {p for p in patterns if not p.startswith(" ")}
        self.words = ahocorasick.Automaton()
        for p in patterns:
            if p.startswith(" "):
                self.words.add_word(p, p)
        if len(self.words):
            self.words.make_automaton()

    def places(self, text: str) -> Iterator[tuple[str, int]]:
        if self.cues:
            for m in CUE_ANYWHERE.finditer(text):
                p = _cue(*m.groups())
                if p in self.cues:
                    yield p, m.end()
        if len(self.words):
            low = text.lower()
            if len(low) != len(text):  # a letter whose lower case is longer stays as it is
                low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
            for end, p in self.words.iter(low):
                yield p, end + 1


def seed_patterns(docs: DataFrame) -> DataFrame:
    """(pattern, places, support) of the contexts that enough different seeds share."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple, int] = {}
            for text in batch.column("text").to_pylist():
                for kind, s, e in seeds(text, base_spans(text)) if text else ():
                    p = context(text, s)
                    if p:
                        key = (p, _digest(text[s:e]))
                        found[key] = found.get(key, 0) + 1
            yield pa.RecordBatch.from_pydict(
                {"pattern": [k[0] for k in found], "instance": [k[1] for k in found],
                 "n": list(found.values())},
                schema=pa.schema([("pattern", pa.string()), ("instance", pa.string()),
                                  ("n", pa.int64())]))

    per_pair = (docs.select("text").mapInArrow(run, "pattern string, instance string, n long")
                .groupBy("pattern", "instance").agg(F.sum("n").alias("n")))
    return written(per_pair.groupBy("pattern").agg(F.sum("n").alias("places"),
                                                   F.count("*").alias("support")), "pii_patterns")


def graph_edges(docs: DataFrame, patterns: list[str]) -> DataFrame:
    """(pattern, instance, kind, n): what the patterns extract over the whole corpus.

    ``kind`` is set for seeds; the row without an instance counts the places
    that no identifier follows.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(patterns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shipped.value)
        for batch in batches:
            found: dict[tuple, int] = {}
            for text in batch.column("text").to_pylist():
                known = None
                for p, at in matcher.places(text) if text else ():
                    if known is None:
                        values = Values(text)
                        known = {s: (k, e) for k, s, e in reversed(seeds(text, base_spans(text)))}
                    key = (p, None, None)
                    if at in known:
                        kind, end = known[at]
                        key = (p, _digest(text[at:end]), kind)
                    else:
                        span = values.span(at)
                        if span and values.identifier(at):
                            key = (p, values.digest(*span), None)
                    found[key] = found.get(key, 0) + 1
            yield pa.RecordBatch.from_pydict(
                {"pattern": [k[0] for k in found], "instance": [k[1] for k in found],
                 "kind": [k[2] for k in found], "n": list(found.values())},
                schema=pa.schema([("pattern", pa.string()), ("instance", pa.string()),
                                  ("kind", pa.string()), ("n", pa.int64())]))

    rows = docs.select("text").mapInArrow(run, "pattern string, instance string, kind string, n long")
    return written(rows.groupBy("pattern", "instance", "kind").agg(F.sum("n").alias("n")),
                   "pii_graph")


def graph(docs: DataFrame, chosen: DataFrame) -> DataFrame | None:
    """The edges of all ``chosen`` patterns, by one pass per ``MAX_PATTERNS`` of them; None without any."""
    parts = -(-chosen.count() // MAX_PATTERNS)
    edges = None
    for k in range(parts):
        mine = chosen.where(F.pmod(F.xxhash64("pattern"), F.lit(parts)) == k)
        patterns = sorted(r["pattern"] for r in mine.select("pattern").collect())
        if patterns:
            part = graph_edges(docs, patterns)
            edges = part if edges is None else edges.union(part)
    return edges


def score_patterns(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, kind, support, confidence) after ``rounds`` of belief over the graph."""
    hits = edges.where("instance IS NOT NULL")
    misses = edges.where("instance IS NULL").groupBy("pattern").agg(F.sum("n").alias("misses"))
    by_kind = (hits.where("kind IS NOT NULL").groupBy("pattern", "kind")
               .agg(F.count("*").alias("support")))
    # the kind that most different seeds of a pattern have; ties go to the first name
    main = (by_kind.groupBy("pattern").agg(F.max(F.struct(
        "support", F.lit(-1) * F.array_position(F.lit(list(KINDS)), F.col("kind")), "kind")).alias("m"))
        .select("pattern", "m.kind", "m.support"))
    size = hits.groupBy("pattern").agg(F.count("*").alias("size"))
    patterns = written(main.join(size, "pattern").join(misses, "pattern", "left").select(
        "pattern", "kind", "support", (F.col("size") + F.coalesce("misses", F.lit(0))).alias("all")),
        "pii_scores")
    # a seed of another kind counts against the pattern
    links = hits.select("pattern", "instance", F.col("kind").alias("seed"))
    confidence = patterns.withColumn("confidence", F.col("support") / F.col("all"))
    small = patterns.count() <= MAX_BROADCAST_ROWS
    for _ in range(rounds):
        weighed = links.join(F.broadcast(confidence) if small else confidence, "pattern")
        doubt = F.log1p(-F.least(F.col("confidence"), F.lit(0.999)))
        belief = (weighed.where("seed IS NULL").groupBy("instance", "kind")
                  .agg((1 - F.exp(F.sum(doubt))).alias("belief")))
        gained = (weighed.where("seed IS NULL").select("pattern", "kind", "instance")
                  .join(belief, ["instance", "kind"]).groupBy("pattern")
                  .agg(F.sum("belief").alias("gained")))
        confidence = written(
            patterns.join(gained, "pattern", "left").withColumn(
                "confidence", (F.col("support") + F.coalesce("gained", F.lit(0.0))) / F.col("all"))
            .drop("gained"), "pii_scores")
    return confidence.select("pattern", "kind", "support", "confidence")


def learn_patterns(docs: DataFrame, min_support: int = MIN_SUPPORT,
                   confidence: float = CONFIDENCE) -> dict[str, str]:
    """Trusted patterns and their kinds, learnt from all of ``docs``."""
    edges = graph(docs, seed_patterns(docs).where(F.col("support") >= min_support))
    if edges is None:
        return {}
    scored = score_patterns(edges)
    good = scored.where((F.col("confidence") >= confidence) & (F.col("support") >= min_support))
    return {r["pattern"]: r["kind"] for r in good.collect()}


def all_spans(text: str | None, matcher: Matcher, kinds: dict[str, str]) -> tuple[list, list]:
    """(base spans, all spans) of a text: base entities, secrets by their form, and what patterns
    find where none of them stands."""
    base = base_spans(text)
    if not text:
        return base, base
    extra = seeds(text, base)[len(base):]
    known = {s: (k, e) for k, s, e in base + extra}
    # places come in order, those behind cues first: what each of the two has taken stays ordered
    taken = [Spans((s, e) for _, s, e in base + extra), Spans(), Spans()]
    values = Values(text)
    for p, at in matcher.places(text):
        if at in known and known[at][0] == kinds[p]:
            span = (at, known[at][1])
        else:
            span = values.span(at)
            if not span or not values.numeric(at):
                continue
        if not any(t.meets(*span) for t in taken):
            extra.append((kinds[p], *span))
            taken[1 + p.startswith(" ")].append(*span)
    order = {k: i for i, k in enumerate(KINDS)}
    return base, sorted(base + extra, key=lambda x: (order[x[0]], x[1]))


def _joined(spans: list) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def personal_data(docs: DataFrame, patterns: dict[str, str] | None = None) -> DataFrame:
    """doc_id, counts, base_sha256 and spans of every text; learns the patterns if not given.

    ``n_secret`` and ``n_spans`` count secrets and all spans, those of patterns included.
    """
    docs = docs.select("doc_id", "text")
    if patterns is None:
        patterns = learn_patterns(docs)
    shipped = docs.sparkSession.sparkContext.broadcast(patterns)

    def make():
        kinds = shipped.value
        matcher = Matcher(list(kinds))

        def compute(texts: list) -> list:
            out: list[list] = [[] for _ in range(8)]
            for text in texts:
                base, spans = all_spans(text, matcher, kinds)
                for column, kind in zip(out, BASE_KINDS):
                    column.append(sum(k == kind for k, _, _ in base))
                out[4].append(hashlib.sha256(_joined(base).encode()).hexdigest())
                out[5].append(_joined(spans))
                out[6].append(sum(k == "secret" for k, _, _ in spans))
                out[7].append(len(spans))
            return out

        return compute

    return append_columns(docs, ["doc_id"], "n_email long, n_ip long, n_card long, n_phone long, "
                          "base_sha256 string, spans string, n_secret long, n_spans long", make)
