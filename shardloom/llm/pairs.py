"""Broken prompt and response pairs: each defective pair with its defect."""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.llm.hotjoin import join_unique
from shardloom.llm.truncation import chunks, form_of, language, media_values, truncation_scores

SHINGLE = 5
#: A response is a copy if this share of its shingles stands in the prompt and their longest common subsequence covers this share of the prompt.
COPIED, COVERED = 0.8, 0.5
#: A sentence is a refusal if a template aligns with this share of its tokens in a stretch no longer than SPREAD times the template.
ALIGNED, SPREAD = 0.8, 1.6
#: Buckets of letter trigrams in the language models; each language asked for has one.
BUCKETS = 1 << 15
#: By how much a trigram must on average favour another language over the one asked for.
MARGIN = 0.15
#: What a kanji or kana weighs beside letters.
WIDE = 3

# Ways to decline, each a run of tokens that a refusing sentence holds with few gaps.
REFUSALS = """
i can t describe this image
i cannot describe this picture
i can t help with this
i cannot assist with that request
i am unable to help with this content
i m unable to describe this
i m not able to provide a caption
i won t be able to provide a description
i will not describe what is shown
i won t describe this image
i cannot comply with that
i can t comply with this request
as an assistant i must decline
i must decline to describe
i have to decline this request
i have to pass on this one
i d rather not caption it
i don t feel comfortable writing about this
i m not comfortable describing this
my instructions do not allow a caption
my guidelines don t permit this
this request goes against my guidelines
this goes against the content policy
no caption will be written
no description can be given for this
this is not something i can caption
it isn t possible for me to comment
is outside what i may do
the content is restricted and will be left without a caption
may breach the usage rules
i refuse to describe
ich kann dieses bild nicht beschreiben
dieses bild kann ich nicht beschreiben
das kann ich leider nicht beschreiben
dabei kann ich nicht helfen
dazu darf ich keine auskunft geben
ich muss die beschreibung ablehnen
ich darf dieses bild nicht beschreiben
ist eine beschreibung hier nicht erlaubt
ohne bildtext weil regeln dagegen sprechen
zu diesem bild kein text erstellt
no puedo describir esta imagen
no puedo ayudar con esta petición
no me es posible ayudar
debo negarme a redactar
no se me permite comentar
prefiero no escribir sobre esta
va contra las normas y queda sin texto
no estoy autorizado a describir
je ne peux pas décrire cette image
je ne peux pas répondre à cette demande
il m est impossible de répondre
je dois refuser de rédiger
je préfère ne rien écrire sur
les règles m interdisent de
ne peut pas être décrite ici
je ne suis pas autorisé à décrire
この画像を説明することはできません
画像の説明は行えません
お答えを控えます
記述できません
作成をお断りします
ご要望にはお応えできません
お手伝いできません
説明できません
"""
# How a log says that a model refused, and that its output was cut.
REFUSED = """
refused by the safety filter
model declined to answer
the assistant would not describe
returned a refusal
blocked prompt or image violates the provider guidelines
content filter completion withheld
model refused the request
"""
CUT_SHORT = """
response incomplete tokens written limit reached
caption field never closed
ended early because the token budget was used up
finish reason length output stopped after tokens
partial caption was discarded
completion hit the maximum output size
before the json was closed
output truncated at the token limit
"""
# Parts of which sentences that decline are composed, by language: each of the first with each of the second.
DECLINING = """
i can t;i cannot;i can not;i am unable to;i m unable to;i m not able to;i am not able to;i won t;i will not;i must decline to;i have to decline to;i refuse to;i d rather not;i would rather not;i prefer not to;i m not allowed to;i am not permitted to;it isn t possible for me to;it is not possible for me to;we cannot | describe;caption;help with;assist with;assist you;help you;comply with;comment on;write about;answer this;answer that;discuss this;discuss that;fulfil this;fulfill this;process this;provide a caption;provide a description;provide that;create a caption
i m not comfortable;i am not comfortable;i don t feel comfortable;i feel uncomfortable | describing;writing;captioning;commenting;discussing;answering
my instructions;my guidelines;my rules;our guidelines;our policy;the guidelines;the policy;content policy;usage policy;usage rules | do not allow;don t allow;do not permit;don t permit;does not allow;doesn t allow;does not permit;doesn t permit;prohibit;prohibits;forbid;forbids;prevent me;prevents me
this request;this image;this picture;this content;this;it;that | goes against my;goes against the policy;goes against the content policy;goes against the rules;violates my;violates the policy;violates the content policy;may violate the;is against my;is outside what i may;breaches the rules;breaches my
no caption;no description;no answer;no text;a caption;a description | will be written;will be given;will be provided;can be given;can be provided;can be written;cannot be given;cannot be provided
as an assistant i;as an ai i;sorry i;sorry but i | cannot;can t;must decline;won t;am unable;am not able;m not able;have to decline
ich kann;ich darf;ich werde;kann ich;darf ich;werde ich | nicht beschreiben;nicht helfen;nicht beantworten;nicht kommentieren;keine beschreibung;keine auskunft;keinen text;nichts schreiben;nicht erstellen
ich muss;muss ich | ablehnen;die beschreibung ablehnen;mich weigern
no puedo;no podré;no me es posible;no estoy autorizado a;no se me permite;debo negarme a;prefiero no;me niego a | describir;ayudar;comentar;redactar;escribir;responder;proporcionar;generar
je ne peux pas;je ne peux;je ne suis pas autorisé à;je ne suis pas en mesure de;je dois refuser de;je préfère ne pas;je préfère ne rien;je refuse de;il m est impossible de;les règles m interdisent de | décrire;aider;vous aider;répondre;rédiger;commenter;écrire;fournir
説明;記述;描写;作成;回答;お答え;お応え;お手伝い;要望にお応え;コメント | できません;できかねます;いたしかねます;することはできません;は行えません;をお断りします;を控えます;を控えさせて
"""
# The same of what a log says of a refusal, and of an output that was cut.
REFUSING = """
model;assistant;safety filter;content filter;moderation;safety system | refused;declined;rejected the prompt;rejected the request;blocked the prompt;blocked the request;withheld;would not describe;would not answer
refused by;declined by;blocked by;withheld by;rejected by | the model;model;the assistant;the safety filter;safety filter;content filter;the content filter;moderation
violates;violated;against | the provider guidelines;provider guidelines;content policy;the content policy;usage policy;safety guidelines
returned a;answered with a | refusal
content filter;safety filter | completion withheld;triggered
"""
CUTTING = """
output;response;completion;caption;answer;generation;reply | truncated;incomplete;cut off;cut short;was cut;stopped at;stopped after;ended early;ends early;hit the maximum;hit the limit;hit the token limit;exceeded the limit;exceeded the token limit;not closed;never closed;field never closed
ended early;stopped early;stopped;cut off;truncated;ended | at the token limit;at the limit;because the token budget;because the limit;before the json;before the closing;after the maximum
token limit;token budget;length limit;maximum length;maximum output;max tokens;output limit | reached;hit;exceeded;used up;was used up;was reached
finish reason;stop reason | length;max tokens
partial caption;partial output;partial response;partial answer | was discarded;discarded;only
"""
# Texts that stand for no value.
NO_VALUE = {"null", "none", "nil", "nan", "na", "n a", "undefined", "empty", "no caption", "no description", "no value", "no text", "not available", "unavailable", "no answer", "no output", "blank", "missing", "keine", "kein wert", "leer", "keine beschreibung", "aucun", "aucune", "vide", "aucune légende", "ninguno", "ninguna", "vacío", "sin descripción", "なし", "無し", "無", "空", "説明なし"}

_TOKEN = re.compile("[぀-ヿ㐀-鿿々]|[^\\W_぀-ヿ㐀-鿿々]+")
_BREAK = re.compile(r"[.!?。！？\r\n](?:(?<=[.!?])\s+|(?<=[。！？])|(?<=[\r\n])[\r\n]*)")
_STATEMENT = re.compile(r"(?i);|\b(?:earlier|details follow|context|last server note):|(?<=[.!?])\s+|(?<=[。！？])|[\r\n]+")
_QUOTED = re.compile(r"\"[^\"\n]{0,200}\"|“[^”\n]{0,300}”|«[^»\n]{0,300}»|„[^“”\n]{0,300}[“”]|「[^」\n]{0,300}」|『[^』\n]{0,300}』")
_QUOTES = re.compile("[\"“«„「『]")
_WIDE = re.compile("[぀-ヿ㐀-鿿]")
_LETTER = re.compile(r"[^\W\d_]|\n")
#: Of each character up to U+FFFF whether it is a letter or the end of a line.
_IS_LETTER = np.zeros(1 << 16, bool)
_IS_LETTER[[m.start() for m in _LETTER.finditer("".join(map(chr, range(1 << 16))))]] = True
#: Characters that are worked on at once.
CHUNK = 300_000


def tokens(text: str) -> list[str]:
    """Words after lower-casing; each kanji or kana is one."""
    return _TOKEN.findall(text.lower())


def lcs(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence. The bits of one whole number are a row of the table: a 0 stands where
    the length grows, so that a token of ``b`` takes one addition, however long ``a`` is."""
    places: dict[str, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        if at := row & places.get(y, 0):
            row = (row + at | row - at) & full
    return len(a) - row.bit_count()


def _sentences(text: str) -> list[str]:
    """Up to white space after a stop, to a stop that needs none, and to the end of a line."""
    out, begin = [], 0
    for m in _BREAK.finditer(text):
        out.append(text[begin : m.start() + (m[0][0] not in "\r\n")])
        begin = m.end()
    return [*out, text[begin:]]


def _unquoted(text: str) -> str:
    """A text without what stands in quotation marks."""
    return _QUOTED.sub(" ", text) if _QUOTES.search(text) else text


class Templates:
    """Runs of tokens, found by their pairs of neighbours and aligned by longest common subsequence: the lines of a text, and
    what is composed of the parts of another, of which every token must stand there."""

    def __init__(self, text: str, parts: str = ""):
        self.runs = [tokens(line) for line in text.strip().splitlines()]
        self.need = [-(-len(run) * ALIGNED // 1) for run in self.runs]
        for line in parts.strip().splitlines():
            begins, ends = (side.split(";") for side in line.split("|"))
            made = [tokens(f"{b} {e}") for b in begins for e in ends]
            self.runs += made
            self.need += map(len, made)
        self.held = [frozenset(run) for run in self.runs]
        self.by = defaultdict(set)
        for k, run in enumerate(self.runs):
            for pair in zip(run, run[1:]):
                self.by[pair].add(k)

    def align(self, words: list[str]) -> bool:
        """Whether a stretch of ``words`` holds ALIGNED of a template."""
        seen = defaultdict(list)
        for i, pair in enumerate(zip(words, words[1:])):
            for k in self.by.get(pair, ()):
                seen[k].append(i)
        have = set(words)
        for k, at in seen.items():
            run = self.runs[k]
            need = self.need[k]
            # Of a run whose tokens aren't there, less can align.
            if len(run) - len(self.held[k] - have) < need:
                continue
            reach = int(len(run) * SPREAD)
            for i in at:
                begin = max(0, i - reach + 2)
                if lcs(run, words[begin : i + reach]) < need:
                    continue
                if any(lcs(run, words[b : b + reach]) >= need for b in range(begin, i + 1)):
                    return True
        return False


_REFUSALS, _REFUSED, _CUT_SHORT = Templates(REFUSALS, DECLINING), Templates(REFUSED, REFUSING), Templates(CUT_SHORT, CUTTING)


def caption_text(text: str) -> str:
    """The caption within JSON or a code fence, also a cut one; other text as it is."""
    body = text.strip()
    if body.startswith("```"):
        body = re.sub(r"^```\w*\s*|\s*```$", "", body)
    if not body.startswith(("{", "[")):
        return body
    try:
        value = json.loads(body, strict=False)
    except ValueError:
        m = re.search(r'"(?:caption|description|text)"\s*:\s*"((?:\\.|[^"\\])*)', body, re.S)
        return m[1].replace('\\"', '"').replace("\\n", "\n") if m else ""
    if isinstance(value, list):
        value = next((v for v in value if isinstance(v, (dict, str))), "")
    if isinstance(value, dict):
        value = next((value[k] for k in ("caption", "description", "text") if k in value), "")
    return value if isinstance(value, str) else ""


def nothing_to_read(text: str | None, words: list[str] | None = None) -> bool:
    """Whether a response is null or holds blanks, invisible characters, punctuation, a word for "no value", or a
    shell of JSON or code fence only."""
    if not text:
        return True
    words = tokens(caption_text(text)) if words is None else words
    return not words or len(words) <= 3 and (" ".join(words) in NO_VALUE or "".join(words) in NO_VALUE)


def declines(text: str, words: list[str] | None = None) -> bool:
    """Whether a response declines: its first sentence is a refusal that makes up 30 % of its letters or more, or
    refusals make up half. What stands in quotation marks is left out."""
    words = tokens(caption_text(text)) if words is None else words
    # Without two neighbours of a template no sentence aligns with one.
    if _REFUSALS.by.keys().isdisjoint(zip(words, words[1:])):
        return False
    plain = _unquoted(caption_text(text))
    refused = total = 0
    first = None
    for s in _sentences(plain):
        words = tokens(s)
        if not words:
            continue
        size = sum(map(len, words))
        is_refusal = _REFUSALS.align(words)
        first = is_refusal if first is None else first
        total += size
        refused += size * is_refusal
    return bool(total) and (refused * 2 >= total or bool(first) and refused * 10 >= total * 3)


def copies(prompt: str | None, text: str, words: list[str] | None = None) -> bool:
    """Whether a response gives back its prompt, whole or for the greater part, without an answer. A list of tags that
    the prompt names is an answer."""
    if not prompt:
        return False
    p, c = tokens(prompt), tokens(caption_text(text)) if words is None else words
    # A word that the prompt lacks is in at least one shingle of its own.
    known = set(p)
    if sum(w in known for w in c) < COPIED * len(c) or form_of(text) == "list" and "?" not in text and ":" not in text:
        return False
    if len(c) < SHINGLE or len(p) < SHINGLE:
        return bool(c) and c == p
    have = {tuple(p[i : i + SHINGLE]) for i in range(len(p) - SHINGLE + 1)}
    own = [tuple(c[i : i + SHINGLE]) for i in range(len(c) - SHINGLE + 1)]
    if sum(s in have for s in own) < COPIED * len(own):
        return False
    return lcs(p, c) >= COVERED * len(p)


def message_says(message: str | None) -> str | None:
    """``refusal`` or ``truncated`` if the log says so, else null. The first statement of a message counts, to its end
    however long; what follows, also after words that announce it, is about something else."""
    words = next(filter(None, map(tokens, _STATEMENT.split(message or ""))), None)
    if not words:
        return None
    if _REFUSED.align(words):
        return "refusal"
    return "truncated" if _CUT_SHORT.align(words) else None


def _trigrams(sentences: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A bucket of each three letters of each sentence, words apart, and how many each sentence has: one at least."""
    codes = np.frombuffer("\n".join(sentences).lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _IS_LETTER[np.minimum(codes, 0xFFFF)]
    for code in np.unique(codes[codes > 0xFFFF]):
        letter[codes == code] = bool(_LETTER.match(chr(code)))
    # What lies between words is one space.
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    kept[:1] = True
    joined = np.where(letter, codes, np.uint32(32))[kept].tobytes().decode("utf-32-le", "surrogatepass").replace("\n", " \n  ")
    codes = np.frombuffer(f"  {joined} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    apart = codes == 10
    inside = ~(apart[:-2] | apart[1:-1] | apart[2:])
    of = np.cumsum(apart)[2:][inside]
    grams = (codes[:-2] * 1_000_003 + codes[1:-1] * 8191 + codes[2:] * 31) % 2_147_483_647 & (BUCKETS - 1)
    return grams[inside], np.bincount(of, minlength=len(sentences))


def _prose(text: str) -> list[str]:
    """The sentences of a response outside of quotation marks."""
    return [s for s in _sentences(_unquoted(caption_text(text))) if s.strip()]


def language_models(pairs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Every language asked for, and the log-probability of each trigram bucket in the responses to each, over all
    responses, without what they quote. Responses in another language than asked are few enough not to matter."""
    names = sorted(r["lang"] for r in pairs.where("lang is not null").select("lang").distinct().collect())
    place = {name: i for i, name in enumerate(names)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[int, np.ndarray] = {}
        for batch in batches:
            held: dict[int, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if lang in place and text:
                    held.setdefault(place[lang], []).extend(_prose(text))
            for k, sentences in held.items():
                for part in chunks(sentences, CHUNK):
                    n[k] = n.get(k, 0) + np.bincount(_trigrams(sentences[part])[0], minlength=BUCKETS)
        for k, counts in n.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(at + k * BUCKETS), pa.array(counts[at])], ["cell", "n"])

    rows = pairs.select("lang", "response").mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(max(1, len(names)) * BUCKETS)
    counts[rows["cell"].to_numpy()] = rows["n"].to_numpy()
    counts = counts.reshape(-1, BUCKETS) + 0.1
    return names, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def foreign_shares(texts: list[str], asked: list[str], names: list[str], models: np.ndarray) -> list[float]:
    """Of each response the share of its letters in sentences of another language than the one asked for. A word counts once
    in a sentence, so that a loop weighs little; a kanji or kana counts as WIDE letters."""
    out = []
    for part in chunks(texts, CHUNK):
        parts = [_prose(t) for t in texts[part]]
        sentences = [s for p in parts for s in p]
        other = np.zeros(0, bool)
        if sentences:
            grams, counts = _trigrams(sentences)
            scores = np.array([np.add.reduceat(m[grams], np.cumsum(counts) - counts) for m in models]) / counts
            own = np.repeat([names.index(a) for a in asked[part]], [len(p) for p in parts])
            other = scores.max(axis=0) - scores[own, np.arange(len(sentences))] >= MARGIN
        begin = 0
        for p in parts:
            foreign, begin = other[begin : begin + len(p)], begin + len(p)
            # Without a sentence in another language there is nothing to weigh.
            if not foreign.any():
                out.append(0.0)
                continue
            sizes = np.array([sum(len(w) if w < "぀" else WIDE * len(w) for w in {w for w in tokens(s) if not w.isdigit()}) for s in p])
            out.append(float(sizes[foreign].sum() / sizes.sum()) if sizes.any() else 0.0)
    return out


def _pairs(caption: DataFrame) -> DataFrame:
    return caption.select("caption_id", "request_id", language(F.col("lang")).alias("lang"), "prompt", F.col("caption").alias("response"))


def _latest_messages(caption: DataFrame, request_map: DataFrame) -> DataFrame:
    """(caption_id, message): of captions that are null or only blanks, the message of the request's row of greatest
    updated_at; at a tie, of greatest log_id."""
    blank = caption.where(F.col("caption").isNull() | F.rlike("caption", F.lit(r"^[\s\p{Z}]*$"))).select("caption_id", "request_id")
    newest = F.max_by(F.struct("error_message"), F.struct("updated_at", "log_id"))
    log = request_map.join(blank.select("request_id").distinct(), "request_id", "left_semi").groupBy("request_id").agg(newest["error_message"].alias("message"))
    return join_unique(blank, log, "request_id").select("caption_id", "message")


def defects(caption: DataFrame, request_map: DataFrame) -> DataFrame:
    """(caption_id, defect) of each defective pair, one defect each, the first that holds of: refusal or truncated, if
    the response is null or only blanks and the request's latest row says so; empty; truncated, if the response was
    cut; refusal; echo; wrong_lang. A null or unknown language asks for none, a null prompt can't be copied."""
    pairs = _pairs(caption)
    names, models = language_models(pairs)
    asked = set(names)
    known = caption.sparkSession.sparkContext.broadcast(models)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = known.value
        for batch in batches:
            found: list[str | None] = []
            rest: list[tuple[int, str, str]] = []
            for k, (lang, prompt, text) in enumerate(zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)))):
                words = tokens(caption_text(text)) if text else []
                if nothing_to_read(text, words):
                    found.append("empty")
                elif declines(text, words):
                    found.append("refusal")
                elif copies(prompt, text, words):
                    found.append("echo")
                else:
                    found.append(None)
                    if lang in asked:
                        rest.append((k, lang, text))
            shares = foreign_shares([t for _, _, t in rest], [a for _, a, _ in rest], names, value)
            for (k, _, _), share in zip(rest, shares):
                if share > 0.5:
                    found[k] = "wrong_lang"
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["caption_id", "seen"])

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = [message_says(m) for m in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(said, pa.string())], ["caption_id", "said"])

    seen = pairs.select("caption_id", "lang", "prompt", "response").mapInArrow(judge, "caption_id bigint, seen string").where("seen is not null")
    said = _latest_messages(caption, request_map).mapInArrow(explain, "caption_id bigint, said string").where("said is not null")
    cut = truncation_scores(media_values(caption, None)).where("cut").select(F.col("row_id").alias("caption_id"), F.lit(True).alias("cut"))
    all_found = seen.select("caption_id", "seen", F.lit(None).cast("string").alias("said"), F.lit(False).alias("cut"))
    all_found = all_found.unionByName(said.select("caption_id", F.lit(None).cast("string").alias("seen"), "said", F.lit(False).alias("cut")))
    all_found = all_found.unionByName(cut.select("caption_id", F.lit(None).cast("string").alias("seen"), F.lit(None).cast("string").alias("said"), "cut"))
    each = all_found.groupBy("caption_id").agg(F.max("seen").alias("seen"), F.max("said").alias("said"), F.max("cut").alias("cut"))
    return each.select("caption_id", _first_defect().alias("defect"))


def _first_defect() -> Column:
    empty = F.col("seen") == "empty"
    return F.coalesce(F.when(empty, F.coalesce("said", "seen")), F.when(F.col("cut"), "truncated"), "seen")


def defect_counts(caption: DataFrame, request_map: DataFrame) -> DataFrame:
    """(lang, defect, pairs): how many pairs of each language asked for have which defect; null for none."""
    found = defects(caption, request_map)
    asked = caption.select("caption_id", language(F.col("lang")).alias("lang"))
    return asked.join(found, "caption_id", "left").groupBy("lang", "defect").agg(F.count("*").alias("pairs"))
