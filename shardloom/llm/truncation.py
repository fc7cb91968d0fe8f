"""Text cut off by field limits: end of text against continuation, by a backward character n-gram model."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.llm.hotjoin import join_unique
from shardloom.session import cut_lineage

#: Context lengths in characters, read backwards from the end, the shorter first. Messages have no longer ones, which
#: would reach into a message before and tell nothing.
ORDERS = (3, 5, 8, 12, 20, 32, 48)
MESSAGE_ORDERS = ORDERS[:5]
#: What a context says weighs as its occurrences, what the next shorter one says as so many.
WEIGHT = 4.0
#: The chance of an end where nothing is known: of prose and messages, and of lists and JSON.
UNKNOWN, UNKNOWN_PARTS = 0.12, 0.5
#: Texts up to this length, of which nothing is known, may as well be complete.
SHORT = 12
#: Bits of the filter that keeps contexts no value ends with out of the shuffle; full, it only filters less.
FILTER_BITS = 1 << 25
#: What other evidence adds to the log-odds: a final stop or closed structure for the end; structure left open or a torn character against it.
STOP, OPEN, TORN = 20.0, -20.0, -8.0
#: Log-odds lie between -SCORES and SCORES, whatever the very end adds; thresholds are looked for in bins of STEP, at most NEAR bins from
#: where they are expected.
SCORES, STEP, NEAR = 14.0, 0.25, 6
#: The threshold is expected in the middle between what this share of held-out cuts lies above and what this share of complete values,
#: their stops left out, lies below. Stops keep most complete values from being taken for cut, so that more may lie below.
MISSED, FALSE = 0.005, 0.02
#: A language with fewer held-out cuts or complete values is expected to have the threshold of its whole field.
LEAST_VALUES = 500
#: Shorter ones are not cut.
LEAST_CUT = 24

#: No mark at the very end of a text is longer.
TAIL = 40

_START = "\x02"
_TORN = re.compile(r"(?:�|\\(?:u[0-9a-fA-F]{0,3}|x[0-9a-fA-F]?)?|&(?:#x?[0-9a-fA-F]*|[A-Za-z]{1,7})?|[\[(<](?:truncated|cut|cut off|abridged|shortened)[\])>])$")
_DOTS = re.compile(r"(?:\.{2,}|…)$")
_FINAL = re.compile(r"[.!?。！？]+[\"'”’»)\]]*$|[.!?。！？]?[\"'”’»」』)\]]*[.!?。！？]$")
_PATH = re.compile(r"(?<!\S)\S*/[^\s.]*")
_DIGITS = re.compile(r"\d+")
#: The end of a longer text is read alone, from a space on.
REACH = 160


def normalised(text: str, paths: bool) -> str:
    """Lower-case; a run of digits as 0, of white space as one space; with ``paths`` the part of a path before its extension as /."""
    text = text.lower()
    if paths and "/" in text:
        text = _PATH.sub("/", text)
    return " " * text[:1].isspace() * (not text.isspace()) + " ".join(_DIGITS.sub("0", text).split())


def form_of(text: str) -> str:
    """json (also fenced), list (of short parts between commas) or prose."""
    if text.lstrip().startswith(("{", "[", "```")):
        return "json"
    if text.count(",") + text.count("、") >= 3 and not re.search(r"[.!?。！？](?:\s|$)", text):
        sizes = [len(p.split()) for p in re.split(r"[,、]", text)]
        if max(sizes) <= 6 and sum(sizes) <= 3.5 * len(sizes):
            return "list"
    return "prose"


def _closed(text: str) -> bool:
    """Whether JSON, fenced or not, is complete."""
    body = text.strip()
    if body.startswith("```"):
        if len(body) < 6 or not body.endswith("```"):
            return False
        body = re.sub(r"^```\w*|```$", "", body).strip()
    try:
        json.loads(body or "null", strict=False)
        return True
    except ValueError:
        return False


def ending(text: str, form: str, paths: bool) -> tuple[str, float, bool]:
    """The text up to where its content ends, what its very end adds to the log-odds, and whether it ends with dots."""
    body = text.rstrip()
    if form == "json":
        return body, STOP if _closed(text) else OPEN, False
    extra, dots = 0.0, False
    while True:
        end = body[-TAIL:]
        if m := _TORN.search(end):
            extra = TORN
        elif m := _DOTS.search(end):
            dots = True
        else:
            break
        body = body[: len(body) - len(end) + m.start()].rstrip()
    if not body:
        return body, STOP, dots
    if not extra and (m := _FINAL.search(body, max(0, len(body) - TAIL))):
        # A stop within a path, as before an extension, is none.
        if not (paths and normalised(body, True).endswith("/.")):
            extra, body = STOP, body[: m.start()]
    return body, extra, dots


def views(text: str, field: str, final: bool) -> list[tuple[str, bool, tuple[int, ...]]]:
    """The forms in which a text is modelled, each normalised, whether as it is (raw), and its context lengths.
    Messages are counted with and without their paths; the end of one is read without if it lies in a path."""
    if field != "error_message":
        # The longest context of a long text lies in its end.
        if final and len(text) > REACH and (space := text.find(" ", len(text) - REACH)) >= 0 and len(end := normalised(text[space:], False)) >= ORDERS[-1]:
            return [(end, False, ORDERS)]
        return [(_START + normalised(text, False), False, ORDERS)]
    both = [(_START + normalised(text, False), True, MESSAGE_ORDERS), (_START + normalised(text, True), False, MESSAGE_ORDERS)]
    return [both["/" in text.split(" ")[-1]]] if final else both


_MIX = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 63, 4096, np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class _Chunk:
    """Normalised texts of a batch behind one another, and hashes of any stretch of them."""

    def __init__(self, texts: list[str], seeds: list[int]):
        self.joined = "".join(texts)
        self.codes = np.frombuffer(self.joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self.codes.astype(np.uint64)
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.starts = np.concatenate([np.zeros(1, np.int64), np.cumsum(self.lengths)[:-1]])
        self.seeds = np.array(seeds, np.int64)
        with np.errstate(over="ignore"):
            values = (_MIX[(codes & np.uint64(4095)).astype(np.int64)] * (codes + np.uint64(1))) ^ (codes << np.uint64(17))
            back, power = (np.full(len(codes) + 1, x, np.uint64) for x in (_BACK, _BASE))
            back[0] = power[0] = 1
            self.power = np.cumprod(power, dtype=np.uint64)
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * np.cumprod(back, dtype=np.uint64)[:-1], dtype=np.uint64)])

    def hashes(self, begin: np.ndarray, end: np.ndarray, salt: np.ndarray) -> np.ndarray:
        """The same for the same characters anywhere, given the same salt."""
        with np.errstate(over="ignore"):
            h = (self.sums[end] - self.sums[begin]) * self.power[end]
            h ^= h >> np.uint64(31)
            h *= np.uint64(0xBF58476D1CE4E5B9) + np.uint64(2) * (end - begin).astype(np.uint64)
            h ^= h >> np.uint64(29)
            # The lowest bit is free for whether the text may be complete after the context.
            return (h.astype(np.int64) ^ (salt << 1)) & ~1


def _seed(field: str, form: str, raw: bool) -> int:
    """Forms of a field have models of their own."""
    return {"prose": 0, "list": 1, "json": 2}[form] + 3 * (field == "error_message") + 6 * raw


def _grouped(fields: list[str], forms: list[str], texts: list[str], final: bool) -> Iterator[tuple[tuple[int, ...], list[int], _Chunk]]:
    """Chunks of the views of texts, each with its context lengths and the places of its texts."""
    by: dict[tuple[int, ...], tuple[list[int], list[str], list[int]]] = {}
    for i, (field, form, text) in enumerate(zip(fields, forms, texts)):
        for body, raw, orders in views(text, field, final):
            at, bodies, seeds = by.setdefault(orders, ([], [], []))
            at.append(i)
            bodies.append(body)
            seeds.append(_seed(field, form, raw))
    for orders, (at, bodies, seeds) in by.items():
        yield orders, at, _Chunk(bodies, seeds)


def final_contexts(chunk: _Chunk, orders: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many contexts each text has at its end, and of them all, text by text, the hash, and whether it is the whole
    text: a text shorter than an order has, at the first such order, its beginning-to-end as context, and none beyond."""
    n, end = chunk.lengths[:, None], (chunk.starts + chunk.lengths)[:, None]
    fits = n >= np.array(orders)
    at = chunk.hashes(end - np.where(fits, orders, n), end, chunk.seeds[:, None] ^ np.where(fits, 0, 64))
    has = np.cumsum(~fits, axis=1) <= 1
    return has.sum(axis=1), at[has], ~fits[has]


_STOPS = re.compile("[\"'”’»」』)\\]]*[.!?。！？…](?=[ .\"'”’»」』)\\]…\x02⺀-\U0010ffff]|$)|[\"'”’»」』)\\]]*[。！？]")


#: Of each character, as bits: a quote or bracket (1), a stop (2), one that ends a sentence whatever follows (4), what may follow a stop (8), a
#: comma (16). The last is that of all characters beyond.
_KINDS = np.zeros(1 << 16, np.uint8)
for _bit, _chars in ((1, "\"'”’»」』)]"), (2, ".!?。！？…"), (4, "。！？"), (8, " .\"'”’»」』)]…" + _START), (16, ",、")):
    _KINDS[[ord(c) for c in _chars]] |= _bit
_KINDS[0x2E80:] |= 8


def _stop_places(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each character belongs to what _STOPS finds, and whether it is a comma; with one place more, the end."""
    kind = np.append(_KINDS[np.minimum(codes, 0xFFFF)], np.uint8(8))
    at = np.flatnonzero(kind & 2)
    at = at[(kind[at + 1] & 8 | kind[at] & 4) != 0]
    stop = np.zeros(len(kind), bool)
    while len(at):
        stop[at] = True
        at = at[at > 0] - 1
        at = at[kind[at] & 1 != 0]
    return stop, kind & 16 != 0


def all_contexts(chunk: _Chunk, orders: tuple[int, ...], forms: list[str], fields: list[str], passes: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the contexts of all texts that ``passes`` lets pass, and whether the text may be complete after each: before a
    final stop that a space, a quote or the end follows; in lists before a comma; in JSON and messages, and where a context
    is the whole text, also at the end. A value that ends with a context ends with the shorter ones, so that where one
    doesn't pass, no longer one is looked up."""
    size = len(chunk.joined)
    stop, commas = _stop_places(chunk.codes)
    owner = np.repeat(np.arange(len(chunk.lengths)), chunk.lengths)
    listed = np.array([f == "list" for f in forms])
    if listed.any():
        stop[:size] = np.where(listed[owner], commas[:size], stop[:size])
    # The place after a text's last character, which is also where the next text starts, comes apart.
    inside = np.arange(size) - chunk.starts[owner]
    salt, ends = chunk.seeds[owner], chunk.starts + chunk.lengths
    ended = np.array([form == "json" or field == "error_message" for form, field in zip(forms, fields)])
    hashes, stops = [], []

    def look(begin: np.ndarray, end: np.ndarray, salt: np.ndarray, stop: np.ndarray) -> np.ndarray:
        h = chunk.hashes(begin, end, salt)
        kept = passes(h)
        hashes.append(h[kept])
        stops.append(stop[kept])
        return kept

    at, last = np.flatnonzero(inside >= orders[0]), np.flatnonzero(ended)
    for order in orders:
        at, last = at[inside[at] >= order], last[chunk.lengths[last] >= order]
        at = at[look(at - order, at, salt[at], stop[at])]
        last = last[look(ends[last] - order, ends[last], chunk.seeds[last], np.ones(len(last), bool))]
    at = np.flatnonzero((inside > 0) & (inside < orders[-1]))
    look(at - inside[at], at, salt[at] ^ 64, stop[at])
    last = np.flatnonzero(chunk.lengths < orders[-1])
    look(chunk.starts[last], ends[last], chunk.seeds[last] ^ 64, np.ones(len(last), bool))
    return np.concatenate(hashes), np.concatenate(stops)


#: Characters that are worked on at once, and where all contexts are looked up, so that their numbers stay in the cache.
CHUNK, CACHED = 400_000, 40_000


def chunks(texts: list[str], most: int = CHUNK) -> Iterator[slice]:
    """Stretches of texts with about ``most`` characters each."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size > most:
            yield slice(begin, i + 1)
            begin, size = i + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def cut_of(text: str, paths: bool) -> tuple[str, float] | None:
    """A complete prose text cut at a place that its hash draws, up to where the cut leaves content, and what its very end
    adds; null if it is too short, or the cut falls where a sentence ends."""
    if len(text) < LEAST_CUT:
        return None
    place = 1 + zlib.crc32(text.encode("utf-8", "surrogatepass"), 7) % (len(text) - 1)
    body, extra, _ = ending(text[:place], "prose", paths)
    if not body or extra == STOP or _STOPS.match(text[place:].lstrip() + "\x02"):
        return None
    return body, extra


def _tails(values: DataFrame) -> DataFrame:
    """(field, row_id, lang, prior, extra, held, contexts, tail): the end of each value, and with ``held`` the end of the held-out
    cut of each complete one. A context comes with whether the value itself is among its stops (1) or its continuations (-1);
    tail identifies all of what the score is made of."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fields, texts = batch.column(0).to_pylist(), batch.column(3).to_pylist()
            for part in chunks(texts):
                own, forms = fields[part], [form_of(t) for t in texts[part]]
                ends = [ending(t, form, f == "error_message") for t, form, f in zip(texts[part], forms, own)]
                places = list(range(part.start, part.start + len(ends)))
                for k, t, form, f, end in list(zip(places, texts[part], forms, own, ends)):
                    if form == "prose" and end[1] == STOP and (made := cut_of(t, f == "error_message")):
                        ends.append((*made, False))
                        forms.append(form)
                        own.append(f)
                        places.append(k)
                held = np.arange(len(ends)) >= part.stop - part.start
                # A stop is counted where it stands, the end of a message, of JSON and of a context that is the whole text too.
                counted = np.array([f == "error_message" or form == "json" or dots or form == "prose" and extra == STOP for f, form, (_, extra, dots) in zip(own, forms, ends)], bool)
                owner, hashes, marks = [], [], []
                for orders, at, chunk in _grouped(own, forms, [e[0] for e in ends], True):
                    sizes, h, whole = final_contexts(chunk, orders)
                    of = np.repeat(np.array(at), sizes)
                    owner.append(of)
                    hashes.append(h)
                    marks.append(np.where(held[of], -1, counted[of] | whole))
                # Each value has one view here, so that its contexts stay in order.
                of = np.concatenate(owner)
                order = np.argsort(of, kind="stable")
                offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.bincount(of, minlength=len(ends)))])
                each = pa.StructArray.from_arrays([pa.array(np.concatenate(hashes)[order], pa.int64()), pa.array(np.concatenate(marks)[order], pa.int32())], ["context", "own"])
                contexts = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), each)
                prior = [UNKNOWN if form == "prose" and len(texts[k]) > SHORT else UNKNOWN_PARTS for form, k in zip(forms, places)]
                rows = pa.array(places, pa.int32())
                out = [*(batch.column(i).take(rows) for i in range(3)), pa.array(prior, pa.float64()), pa.array([e[1] for e in ends], pa.float64()), pa.array(held), contexts]
                yield pa.RecordBatch.from_arrays(out, ["field", "row_id", "lang", "prior", "extra", "held", "contexts"])

    ends = values.mapInArrow(read, "field string, row_id bigint, lang string, prior double, extra double, held boolean, contexts array<struct<context: bigint, own: int>>")
    return ends.withColumn("tail", F.xxhash64("prior", "extra", "contexts"))


def context_counts(values: DataFrame, tails: DataFrame) -> DataFrame:
    """(context, stop, cont): over all values, how often the text may be complete after a context and how often it
    goes on, for the contexts that some value ends with (and a few that the filter lets pass)."""
    finals = tails.select(F.explode("contexts.context").alias("c"))
    word = F.expr(f"(c >> 1) & {FILTER_BITS - 1}")
    bits = finals.groupBy((F.shiftright(word, 6)).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast((c >> 1) & 63 as int))")).alias("b")).toArrow()
    table = np.zeros(FILTER_BITS // 64, np.int64)
    table[bits["w"].to_numpy()] = bits["b"].to_numpy()
    known = values.sparkSession.sparkContext.broadcast(table)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = known.value

        def passes(h: np.ndarray) -> np.ndarray:
            low = (h >> 1) & (FILTER_BITS - 1)
            return (flags[low >> 6] >> (low & 63)) & 1 == 1

        for batch in batches:
            fields, texts = batch.column(0).to_pylist(), batch.column(3).to_pylist()
            for most in chunks(texts, 10 * CHUNK):
                met = []
                for small in chunks(texts[most], CACHED):
                    part = slice(most.start + small.start, most.start + small.stop)
                    forms = [form_of(t) for t in texts[part]]
                    for orders, at, chunk in _grouped(fields[part], forms, [t.rstrip() for t in texts[part]], False):
                        h, s = all_contexts(chunk, orders, [forms[i] for i in at], [fields[part][i] for i in at], passes)
                        met.append(h | s)
                seen = pc.value_counts(pa.array(np.concatenate(met)))
                keys, n = seen.field("values").to_numpy(), seen.field("counts").to_numpy()
                ends = keys & 1
                keys, stop, cont = keys & ~1, n * ends, n * (1 - ends)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(stop), pa.array(cont)], ["context", "stop", "cont"])

    found = values.mapInArrow(count, "context bigint, stop bigint, cont bigint")
    return found.groupBy("context").agg(F.sum("stop").alias("stop"), F.sum("cont").alias("cont"))


def _scored(tails: DataFrame, counts: DataFrame) -> DataFrame:
    """(tail, score) of each distinct tail: the chance of an end, passed from the shortest context to the longest, each
    of which corrects it by its own counts, as log-odds, plus what the very end adds."""
    distinct = cut_lineage(tails.groupBy("tail").agg(F.first("prior").alias("prior"), F.first("extra").alias("extra"), F.first("contexts").alias("contexts")))
    at = distinct.select("tail", "prior", "extra", F.posexplode("contexts").alias("order", "c")).select("tail", "prior", "extra", "order", "c.context", "c.own")
    met = join_unique(at, counts, "context")
    stop = F.greatest(F.coalesce("stop", F.lit(0)) - F.greatest("own", F.lit(0)), F.lit(0)).cast("double")
    cont = F.greatest(F.coalesce("cont", F.lit(0)) + F.least("own", F.lit(0)), F.lit(0)).cast("double")
    chain = F.transform(F.array_sort(F.collect_list(F.struct("order", stop.alias("stop"), cont.alias("cont")))), lambda c: F.struct(c["stop"].alias("stop"), c["cont"].alias("cont")))
    each = met.groupBy("tail").agg(F.first("prior").alias("prior"), F.first("extra").alias("extra"), chain.alias("chain"))
    p = F.aggregate("chain", F.col("prior"), lambda p, c: (c["stop"] + WEIGHT * p) / (c["stop"] + c["cont"] + WEIGHT))
    p = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return each.select("tail", (F.log(p / (1 - p)) + F.col("extra")).alias("score"))


def expected_threshold(cuts: np.ndarray, ends: np.ndarray, many: bool = True) -> float:
    """The bin, with a fraction, in the middle between the upper quantile of held-out cuts and the lower one of complete values, both
    by bin and over all values; with ``many`` values that of complete ones, if the cuts' is above: what is cut there looks complete. Without
    cuts or without complete values that quantile is the middle of the scale."""

    def quantile(n: np.ndarray, share: float) -> float:
        total = n.cumsum()
        k = int(np.searchsorted(total, share * total[-1]))
        return k + (share * total[-1] - total[k] + n[k]) / n[k] if total[-1] and n[k] else len(n) / 2

    high, low = quantile(cuts, 1 - MISSED), quantile(ends, FALSE)
    return min((high + low) / 2, low) if many else (high + low) / 2


def _thresholds(scored: DataFrame) -> DataFrame:
    """(field, lang, threshold, expected) for each field and language. ``expected`` is that of its held-out cuts and complete
    values, or of the field's; the threshold is the middle of the emptiest bin of values with its two neighbours, below 0 and
    at most NEAR bins away, where each bin away counts as one value or one in 2000."""
    n_bins = round(2 * SCORES / STEP)

    def index(score: Column) -> Column:
        return F.greatest(F.least(F.floor((score + SCORES) / STEP), F.lit(n_bins - 1)), F.lit(0)).cast("int")

    complete = ~F.col("held") & (F.col("extra") == STOP)
    all_ = scored.groupBy("field", "lang", "held", index(F.col("score")).alias("bin")).agg(F.count("*").alias("n"))
    bare = scored.where(complete).groupBy("field", "lang", index(F.col("score") - STOP).alias("bin")).agg(F.count("*").alias("n"))
    # A row for each field, language and bin at most.
    rows, ends = all_.collect(), bare.collect()

    def bins(of: list) -> np.ndarray:
        out = np.zeros(n_bins)
        for r in of:
            out[r["bin"]] += r["n"]
        return out

    out = []
    for field in sorted({r["field"] for r in rows}):
        cuts, whole = [r for r in rows if r["field"] == field and r["held"]], [r for r in ends if r["field"] == field]
        for lang in sorted({r["lang"] for r in rows if r["field"] == field and not r["held"]}, key=repr):
            pair = [bins([r for r in side if r["lang"] == lang]) for side in (cuts, whole)]
            many = min(p.sum() for p in pair) >= LEAST_VALUES
            at = expected_threshold(*(pair if many else (bins(cuts), bins(whole))), many)
            own = bins([r for r in rows if r["field"] == field and r["lang"] == lang and not r["held"]])
            near = np.convolve(own, [1, 1, 1], "same")
            # Above 0 the end is more likely than that the text goes on.
            at = min(at, n_bins / 2 - 0.5)
            away = np.abs(np.arange(n_bins) + 0.5 - at)
            open_ = (np.arange(n_bins) < n_bins // 2) & (away <= NEAR)
            cost = np.where(open_, near + away * max(1.0, own.sum() / 2000), np.inf)
            out.append((field, lang, (int(cost.argmin()) + 0.5) * STEP - SCORES, float(at * STEP - SCORES)))
    return scored.sparkSession.createDataFrame(out, "field string, lang string, threshold double, expected double")


def language(code: Column) -> Column:
    """The first two letters of a language code, lower-case; null for null and blank."""
    return F.nullif(F.substring(F.lower(F.btrim(code)), 1, 2), F.lit(""))


def truncation_scores(values: DataFrame) -> DataFrame:
    """(field, row_id, lang, score, threshold, cut) of each value of (field, row_id, lang, text) that isn't null or
    blank. ``score`` is the log-odds that the text ends here against going on, given its last characters and how
    it ends; ``cut`` whether it lies below the threshold of its field and language. Each row counts."""
    values = values.where(F.col("text").isNotNull() & (F.btrim(F.col("text"), F.lit(" \t\r\n　​")) != ""))
    tails = cut_lineage(_tails(values))
    # The join below reads both of its sides twice; the corpus is hashed once.
    scores = cut_lineage(_scored(tails, cut_lineage(context_counts(values, tails))))
    scored = cut_lineage(join_unique(tails.select("field", "row_id", "lang", "extra", "held", "tail"), scores, "tail"))
    limits = _thresholds(scored).select(F.col("field").alias("f"), F.col("lang").alias("l"), "threshold")
    out = scored.where("not held").join(F.broadcast(limits), (F.col("field") == F.col("f")) & F.col("lang").eqNullSafe(F.col("l")))
    return out.select("field", "row_id", "lang", "score", "threshold", (F.col("score") < F.col("threshold")).alias("cut"))


def media_values(caption: DataFrame, request_map: DataFrame | None) -> DataFrame:
    """(field, row_id, lang, text) of captions and error messages. Messages are in one language."""
    out = caption.select(F.lit("caption").alias("field"), F.col("caption_id").alias("row_id"), language(F.col("lang")).alias("lang"), F.col("caption").alias("text"))
    if request_map is None:
        return out
    return out.unionAll(request_map.select(F.lit("error_message"), F.col("log_id"), F.lit("en"), F.col("error_message")))


def truncated(caption: DataFrame, request_map: DataFrame) -> DataFrame:
    """(field, row_id) of the values that were cut."""
    return truncation_scores(media_values(caption, request_map)).where("cut").select("field", "row_id")


def truncation_rates(caption: DataFrame, request_map: DataFrame, batch_state: DataFrame) -> DataFrame:
    """(provider, field, present, cut, share): of each source's values that aren't null or blank, how many were cut.
    Rows of an unknown batch have a null provider."""
    scored = truncation_scores(media_values(caption, request_map)).select("field", "row_id", "cut")
    batches = caption.select(F.lit("caption").alias("field"), F.col("caption_id").alias("row_id"), "batch_id").unionAll(request_map.select(F.lit("error_message"), "log_id", "batch_id"))
    source = batch_state.groupBy("batch_id").agg(F.min("provider").alias("provider"))
    joined = scored.join(batches, ["field", "row_id"]).join(F.broadcast(source), "batch_id", "left")
    return joined.groupBy("provider", "field").agg(F.count("*").alias("present"), F.count_if("cut").alias("cut")).withColumn("share", F.col("cut") / F.col("present"))
