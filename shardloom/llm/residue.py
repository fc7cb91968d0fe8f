"""Template residue and error-page text: character n-gram likelihood-ratio windows and coverage."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.textnorm import repair

ORDER = 5
#: Buckets of each model's n-grams, whatever the corpus.
BUCKETS = 1 << 18
#: The share of each model that is uniform, so that n-grams no model knows favour none.
UNIFORM = 0.05
#: Characters of a window, the mean log-ratio from which it is residue, and the share of a sentence's windows from which the sentence is.
WINDOW, RATIO, SENTENCE = 16, 0.5, 0.55
#: Shorter sentences are no residue by themselves.
LEAST = 8
#: A document is excluded if residue makes up this share of it, without menus, or if beside it at most FEW sentences
#: of LITTLE characters together stand.
COVERAGE, FEW, LITTLE = 0.4, 2, 200
#: Characters that are worked on at once.
CHUNK = 300_000

# Texts that stand where a description should be written.
LOREM = """
lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua quis
nostrud nulla vel velit purus morbi erat sapien orem urna vitae nisi
"""
FILLER = """
lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua
ut enim ad minim veniam quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat
duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur
excepteur sint occaecat cupidatat non proident sunt in culpa qui officia deserunt mollit anim id est laborum
nulla velit purus orem amet. morbi vitae quis erat urna. vel sapien nisi magna tempor sit ipsum. aliqua dolor lorem
placeholder text. placeholder description, to be written by the annotator. dummy text. dummy caption. dummy summary 1. dummy title
sample text. replace me. your text here. your caption goes here. your title goes here. caption goes here. enter text here
insert caption here. insert text here. insert summary here. insert character note here. insert scene text here. insert title here
text coming soon. description coming soon. caption coming soon. coming soon
describe the image here (max. 200 words). describe the scene here. write a caption here. write your description here
no description yet - fill in. no tags yet - fill in. no caption yet - fill in. fill in later. to be filled in. to be added. to be written
put the tags for this clip here later. put the caption here. add the description later. will be added later. text follows. content follows
tbd (summary). tbd (caption). todo: write caption. todo: add description. tba
foo bar baz 12. foo bar baz qux. foo bar
blah blah blah. bla bla bla
test test 12 test caption test. test test test. this is a test. testing 123. example example caption example. example caption. caption caption caption
asdf asdf qwer asdf. asdfasdf qwerty. qwer asdf. xxx xxx xxx. abc abc abc
hier steht später die bildbeschreibung. hier text eintragen. hier title eintragen. hier beschreibung einfügen. platzhaltertext. beispieltext. blindtext
aquí va la descripción. aquí va el texto. escribir caption aquí. escribir texto aquí. texto de ejemplo. texto de relleno. texto provisional
texte à venir. description à venir. votre texte ici. insérer le texte ici. insérer la légende ici. texte de remplissage. exemple de texte
ここに説明を入力してください。ここにテキストを入力。ここにtagsを書く。ここに説明を書く。ここにキャプションを書く。ダミーテキスト。サンプルテキスト。説明文がここに入ります。キャプションを入力
"""
# What such a text stands for, and how it says so.
KINDS = "caption;description;text;title;summary;tags;note;alt text;scene text;character note;image description"
FORMS = """
tbd (KIND);put the KIND for clip 1 here later.;put KIND here;insert KIND here;enter KIND here;add KIND here;no KIND yet - fill in;no KIND yet;KIND coming soon;KIND to follow
dummy KIND 1;sample KIND;example KIND;test KIND;your KIND goes here;KIND goes here;placeholder KIND, to be written by the annotator.;todo: write KIND;describe the KIND here
test test 1 test KIND test;example example KIND example;xxx KIND xxx;lorem KIND ipsum;ここにKINDを書く;hier KIND eintragen;escribir KIND aquí;KIND à venir;KIND folgt
"""
# Error pages and notices that scripts are needed.
NOTICES = """
400 bad request. 401 sign-in required. 401 unauthorized. 403 forbidden. 404 not found. 404 page not found. 404 nothing here. 408 request timeout. 410 gone. 429 too many requests. 429 slow down
500 internal server error. 502 bad gateway. 502 bad answer from upstream. 503 service unavailable. 503 temporarily unavailable. 504 gateway timeout
bad request (400). sign-in required (401). forbidden (403). nothing here (404). gone (410). slow down (429). internal server error (500). bad answer from upstream (502). temporarily unavailable (503). gateway timeout (504). not found (404)
http error 404. http error 500. http error 503. error 404. error code 500. error code: 404
the page you asked for does not exist or has been moved. the page you requested could not be found. page not found. go back to the start page. return to the front page. back to home
the requested url was not found on this server. the server encountered an internal error. the server is temporarily unable to service your request
an unexpected condition stopped the request. something went wrong. something went wrong on our side. we have been told and are looking into it. if this keeps happening, quote a1b2c3d4. incident c7a52e432b5b. reference id
service unavailable. we are down for maintenance. the mirror is being repaired. temporarily unavailable. the site is under maintenance
the gateway received an invalid answer. the storage backend did not answer in time. worker 12 closed the connection. the server took too long to respond. this site can't be reached. the connection was reset
access denied. you do not have permission to open this clip. you do not have permission to access this resource. this set is private or has been taken down
too many requests. your address has been limited for 5 minutes. reload in 30 seconds. please try again later. try again in 10 minutes. try again later
session expired. log in again to see this description. please log in. sign in to continue. your link has expired or was never valid
the gallery could not be loaded. the player cannot start. the preview server is over capacity. we could not find the clip you were looking for. the page could not be loaded. failed to load resource
error code 500 message upstream timed out trace. error message internal error status 500. error code 404 message not found. status error detail unauthorized
{"error": {"code": 500, "message": "upstream timed out", "trace": "a1b2c3d4"}}
{"error": {"code": 503, "message": "service unavailable"}}
{"error": "not found", "status": 404}
{"detail": "internal server error"}
nosuchobject the object does not exist. nosuchkey the specified key does not exist. accessdenied. error code message request id
checking that you are not a robot... checking your browser before accessing. verify you are human. please complete the captcha
please enable javascript to continue. please enable javascript. enable javascript and cookies to continue. javascript is disabled. javascript is required. some parts of this page will not load
this app does not work without javascript. you need to enable javascript to run this app. switch it on and reload. switch on javascript and load the page again
you need to turn on scripts in your browser to view this gallery. turn off your script blocker. allow scripts for this site. scripts and cookies must be allowed. your browser must be able to run scripts
use a browser with javascript support. scripting is blocked or not supported here. the viewer requires scripting support. your browser does not support javascript
before you go on, use a browser with javascript support. for the full gallery, allow scripts for this site. to see the captions, turn off your script blocker. notice: scripting is blocked or not supported here. noscript
seite nicht gefunden. fehlercode 404. fehler 404. fehler 500. interner serverfehler. zugriff verweigert. die seite wurde nicht gefunden oder verschoben. dienst nicht verfügbar
bitte aktivieren sie javascript, um diese seite anzuzeigen. ihr browser führt keine skripte aus. ohne skripte bleibt die galerie leer. javascript ist deaktiviert
página no encontrada. error 404. error interno del servidor. vuelva a intentarlo en unos minutos. acceso denegado. servicio no disponible
active los scripts del navegador para ver el contenido. habilite javascript para continuar. javascript está desactivado. su navegador no admite scripts
page introuvable. erreur 404 : la page demandée est introuvable. erreur interne du serveur. accès refusé. service indisponible. réessayez plus tard
activez javascript pour afficher la vidéo. activez javascript pour continuer. javascript est désactivé. votre navigateur n'exécute pas les scripts
ページが見つかりません。お探しのページは移動または削除された可能性があります。サーバーエラーが発生しました。アクセスが拒否されました。しばらくしてからもう一度お試しください
このページを表示するには、javascriptを有効にしてください。スクリプトを有効にしてください。javascriptが無効です
"""
# Words of menus, of which a line holds nothing else.
MENU = {"home", "gallery", "upload", "contact", "search", "sign in", "sign up", "log in", "login", "register", "help", "terms", "about", "language", "tags", "clips", "menu", "faq", "privacy", "imprint", "news", "blog", "profile", "settings", "back", "next"}

_COPYRIGHT = re.compile(r"^(?:©|\(c\)|copyright)\s*\d{4}\b.{0,60}$", re.I)
_HEADING = re.compile(r"^#{1,6}\s+\S.{0,60}$")
_BREAK = re.compile(r"[\r\n]+|(?<=[.!?])\s+|(?<=[。！？])")
_MARKUP = re.compile(r"<[/!?]?[A-Za-z][^<>]*>")
_QUOTED = re.compile(r"`[^`\n]{1,200}`|\"[^\"\n]{1,200}\"|“[^”\n]{1,200}”|«[^»\n]{1,200}»|„[^“”\n]{1,200}[“”]|「[^」\n]{1,200}」")
_LINE, _GAP = re.compile(r"[\r\n]+"), re.compile("\0+")
_JSON = re.compile(r'^\s*[{\["]|"\s*:')
_MARK, _AFTER, _KEY = re.compile(r'(?<!\\)"'), re.compile(r"\s*(?:[,:\]}]|$)"), re.compile(r'"[^"\s]{1,60}"\s*:')
_CLOSED = re.compile(r'"\s*[,:\]}]')
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")

# The ways in which templates mark a slot.
_SLOT = re.compile(
    r"""\{\{\s*[A-Za-z_][\w .|-]{0,40}\}\}      # {{ name }}
      | [$#]\{\s*[A-Za-z_][\w .]{0,40}\}        # ${name} #{name}
      | <%=?[^<>%\n]{1,40}%>                    # <%= name %>
      | %\([A-Za-z_]\w{0,30}\)[sdf]             # %(name)s
      | %[A-Z][A-Z_]{1,30}%                     # %NAME%
      | (?<![\w%])%[sd](?!\w)                   # %s
      | \{(?:[A-Za-z_]\w{0,30}|\d{1,2}|)\}      # {name} {0} {}
      | \[\[[A-Za-z_][\w .]{0,40}\]\]           # [[name]]
      | <<[A-Za-z_][\w .]{0,40}>>               # <<name>>
      | \[(?:TODO|TBD|FIXME|INSERT|ENTER|ADD|YOUR|NAME|PLACEHOLDER)\b[^\[\]\n]{0,40}\]
      | \[[A-Za-z]+[ _](?:name|text|title|here|description|caption|tags?|date|style|place|note)\]
      | <(?:INSERT|ENTER|YOUR|ADD|TODO)\b[^<>\n]{0,40}>
      | <(?i:insert|enter|your|add)\s[^<>\n]{1,40}>
      | (?<!\w)(?:__[A-Z][A-Z_]{1,30}__|@@\w{2,30}@@|\#\#[A-Z_]{2,30}\#\#|\$[A-Z][A-Z_]{2,30}\$|~~[A-Z_]{2,30}~~)(?!\w)
      | (?<![\w])X{4,}(?![\w]) | 〇〇+ | ○○+ | ＿{3,} | (?<!\w)_{4,}(?!\w)
    """,
    re.X,
)
_HINT = re.compile(r"[{%$#@\[<~〇○＿]|__|XXXX")
# Slots as templates mark them, from which the model of slots is fitted; NAME stands for any of NAMES.
SLOTS = """
{{NAME}} {{ NAME }} ${NAME} #{NAME} <%= NAME %> <%NAME%> %(NAME)s %(NAME)d %NAME% %s %d {NAME} {} {0} [[NAME]] <<NAME>>
[TODO] [TBD] [TODO: NAME] [FIXME NAME] [INSERT NAME] [ENTER NAME] [ADD NAME] [YOUR NAME] [NAME] [PLACEHOLDER] [insert NAME here] [NAME here] [NAME text] [NAME title] [NAME_caption]
<INSERT NAME> <ENTER NAME HERE> <YOUR NAME> <ADD NAME> <TODO> <insert NAME> <enter NAME here> <your NAME> <add NAME>
__NAME__ @@NAME@@ ##NAME## $NAME$ ~~NAME~~ XXXX XXXXXX 〇〇 〇〇〇 ○○ ＿＿＿ ＿＿＿＿ ____ ______
"""
NAMES = "title;value;caption;subject;scene_text;user name;NAME;VALUE;CAPTION_TEXT;USER NAME;x;item1;a.b"
AROUND = "^;a ^ a;^ a;^, a;a: ^;0 ^ a;0 ^。;a ^.;a ^;\"^\";a=^;(^);/^/"
#: Words that say what a slot waits for; in shapes they stand apart from others.
WAITING = frozenset("todo tbd fixme insert enter add your name placeholder text title here description caption tag tags date style place note".split())
#: Pieces of an n-gram of shapes, buckets of their models, n-grams of a window.
PIECES, SHAPES, SPAN = 3, 1 << 16, 3
# Words of a sentence that speaks about slots.
_ABOUT = re.compile(r"\b(?:placeholders?|templates?|variables?|brackets?|braces?|literals?|syntax|loader|profiles?|unfilled|escaped?|explained|replaced by|converted)\b", re.I)


def sentences(text: str) -> list[str]:
    """Lines and sentences, repaired, with single spaces."""
    return [t for s in _BREAK.split(repair(text)) if (t := _SPACE.sub(" ", s).strip(" \ufeff"))]


def plain(sentence: str) -> str:
    """What the models read: lower-case, without markup, digits as 0."""
    if "<" in sentence:
        sentence = _SPACE.sub(" ", _MARKUP.sub(" ", sentence)).strip()
    return _DIGITS.sub("0", sentence.lower())


class _Grams:
    """The buckets of all n-grams of many texts, each with a space at both ends."""

    def __init__(self, texts: list[str]):
        lengths = np.array([len(t) + 2 for t in texts], np.int64)
        codes = np.frombuffer("".join(f" {t} " for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        ends = np.cumsum(lengths)
        with np.errstate(over="ignore"):
            h = np.zeros(max(0, len(codes) - ORDER + 1), np.uint64)
            for k in range(ORDER):
                h = h * np.uint64(0x100000001B3) + codes[k : len(codes) - ORDER + 1 + k]
            h *= np.uint64(0x9E3779B97F4A7C15)
        buckets = (h >> np.uint64(40)).astype(np.int64) & (BUCKETS - 1)
        # N-grams that reach into the next text go.
        owner = np.repeat(np.arange(len(texts)), lengths)[: len(buckets)]
        inside = np.arange(len(buckets)) + ORDER <= ends[owner]
        self.buckets, self.owner = buckets[inside], owner[inside]
        self.count = np.bincount(self.owner, minlength=len(texts))
        self.start = np.cumsum(self.count) - self.count

    def shares(self, ratios: np.ndarray) -> np.ndarray:
        """Of each text the share of its windows whose mean ratio reaches RATIO by the model most in favour."""
        n, at = len(self.buckets), np.arange(len(self.buckets))
        best = np.zeros(len(self.count))
        if not n:
            return best
        end = (self.start + self.count)[self.owner]
        to = np.minimum(at + WINDOW, end)
        valid = (at + WINDOW <= end) | (at == self.start[self.owner])
        total = np.maximum(1, np.bincount(self.owner, valid, len(self.count)))
        for row in ratios:
            sums = np.concatenate([np.zeros(1), np.cumsum(row[self.buckets], dtype=np.float64)])
            marked = valid & (sums[to] - sums[at] >= RATIO * (to - at))
            best = np.maximum(best, np.bincount(self.owner, marked, len(self.count)) / total)
        return best


def _chunks(texts: list[str | None]) -> Iterator[list[str | None]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t or "")
        if size > CHUNK:
            yield part
            part, size = [], 0
    if part:
        yield part


def chrome(sentence: str) -> bool:
    """Whether a line is a menu, copyright notice or heading."""
    if _COPYRIGHT.match(sentence) or _HEADING.match(sentence):
        return True
    words = [w.strip().lower() for w in re.split(r"[|·•/>»]|\s-\s", sentence) if w.strip()]
    return bool(words) and all(w in MENU for w in words)


def _parts(line: str) -> list[tuple[int, int, bool]]:
    """Where the strings of JSON in a line begin and end, with their marks, and what is between them (begin, end,
    whether it is a string). A string begins after { [ , : or at the line's begin and ends before , : ] } or the line's
    end; a mark that is neither, as where a slot took the other, is text. Broken JSON pairs anew at the next key."""
    out, at, begin = [], 0, None
    if '"' in line and _JSON.search(line):
        for m in _MARK.finditer(line):
            i = m.start()
            opens = line[max(0, i - 8) : i].rstrip()[-1:] in ("{", "[", ",", ":") or not line[:i].strip()
            if begin is None or opens and _KEY.match(line, i):
                begin = i if opens else None
            elif _AFTER.match(line, i + 1):
                out += [(at, begin, False), (begin, i + 1, True)]
                at, begin = i + 1, None
    return [*out, (at, len(line), False)]


def _unquoted(part: str) -> str:
    """With quotations and code as zero characters; a mark that closes a string of JSON begins no quotation."""
    return _QUOTED.sub(lambda m: m[0] if _CLOSED.match(m[0]) else "\0" * len(m[0]), part)


def _read(text: str, ratios: np.ndarray | None) -> Iterator[tuple[str, str, list[str]]]:
    """Each sentence, as it is and without quotations and code, and its unfilled slots: windows of ``ratios`` localise
    them (None: anywhere), the ways in which templates mark a slot are looked for there. Quotation marks are paired
    over the whole line, before it is cut into sentences; strings of JSON stay. No slot is in a quotation or code, nor where
    the sentence speaks about slots in other words than the slot's, within the same string of JSON or outside of any."""
    for line in _LINE.split(repair(text)):
        parts = _parts(line)
        bare = "".join(f'"{_unquoted(line[a + 1 : b - 1])}"' if held else _unquoted(line[a:b]) for a, b, held in parts)
        breaks = [m.span() for m in _BREAK.finditer(line)]
        for a, b in zip([0, *(e for _, e in breaks)], [*(s for s, _ in breaks), len(line)]):
            whole = _SPACE.sub(" ", line[a:b]).strip(" \ufeff")
            if not whole:
                continue
            found = []
            if _HINT.search(whole):
                inner = [(max(a, x), min(b, y), held) for x, y, held in parts if x < b and y > a]
                for spans in ([(x, y) for x, y, held in inner if not held], *([(x, y)] for x, y, held in inner if held)):
                    seen, said = (_SPACE.sub(" ", '"'.join(s[x:y] for x, y in spans)) for s in (bare, line))
                    seen = _GAP.sub(" ", seen)
                    marked = [(0, len(seen))] if ratios is None else slot_windows(seen, ratios)
                    slot = [m[0] for m in _SLOT.finditer(seen) if any(x < m.end() and y > m.start() for x, y in marked)] if marked else []
                    if slot and not _ABOUT.search(_SLOT.sub(" ", said)):
                        found += slot
            yield whole, _GAP.sub(" ", _SPACE.sub(" ", bare[a:b]).strip(" \ufeff")), found


def slots(text: str, ratios: np.ndarray | None = None) -> list[str]:
    """The unfilled slots of a text."""
    return [x for _, _, found in _read(text, ratios) for x in found]


_PIECE = re.compile(r"[^\W\d_]+|\d+|\s+|.", re.S)
_PLAIN = frozenset("aA0 .,;:!?-'()/\"")


def shape(text: str) -> tuple[str, list[int]]:
    """A text with one character for each piece, and where each piece ends: of a word a, A, w or W (in capitals, one that
    says what a slot waits for), its letter if it has one, X or 〇 if it repeats that; of digits 0; of white space a
    space; of any other character itself."""
    out, ends = [], []
    for m in _PIECE.finditer(text):
        w = m[0]
        if w[0].isalpha() or w[0].isnumeric() and not w[0].isdecimal():
            if w[0] in "X〇○" and len(w) > 1 and len(set(w)) == 1:
                c = w[0]
            elif len(w) == 1 and w.isascii():
                c = w
            else:
                c = ("W" if w.isupper() else "w") if w.lower() in WAITING else "A" if w.isupper() else "a"
        else:
            c = "0" if w[0].isdecimal() else " " if w[0].isspace() else w[0]
        out.append(c)
        ends.append(m.end())
    return "".join(out), ends


def _shape_grams(shaped: str) -> np.ndarray:
    """The bucket of each PIECES pieces, with spaces at both ends, so that each piece is in PIECES n-grams; 0 for those
    without a mark."""
    text = f"  {shaped}  "
    grams = (text[i : i + PIECES] for i in range(len(text) - PIECES + 1))
    return np.array([0 if _PLAIN.issuperset(g) else 1 + zlib.crc32(g.encode("utf-8", "surrogatepass")) % (SHAPES - 1) for g in grams], np.int64)


def _slot_counts() -> np.ndarray:
    """The n-grams of shapes that hold a piece of a slot."""
    n = np.zeros(SHAPES)
    for form in re.findall(r"\[[^\[\]]+\]|<[A-Za-z][^<>]+>|\S+", SLOTS.replace("{{ NAME }}", "{{_NAME_}}").replace("<%= NAME %>", "<%=_NAME_%>")):
        for name in NAMES.split(";"):
            slot = shape(form.replace("_NAME_", " NAME ").replace("NAME", name))[0]
            for around in AROUND.split(";"):
                before, after = around.split("^")
                grams = _shape_grams(before + slot + after)
                own = grams[len(before) : len(before) + len(slot) + PIECES - 1]
                n += np.bincount(own[own > 0], minlength=SHAPES)
    return n


def slot_ratios(natural: np.ndarray) -> np.ndarray:
    """Log-ratio of slots to natural text of each bucket of shapes."""
    slot, all_ = _slot_counts(), max(1, natural.sum())
    return np.log((1 - UNIFORM) * slot / slot.sum() + UNIFORM / SHAPES) - np.log((1 - UNIFORM) * natural / all_ + UNIFORM / SHAPES)


def slot_windows(text: str, ratios: np.ndarray) -> list[tuple[int, int]]:
    """Where in a text windows of SPAN n-grams of shapes speak for a slot: (begin, end) of each such run."""
    shaped, ends = shape(text)
    sums = np.concatenate([[0.0], np.cumsum(ratios[_shape_grams(shaped)])])
    out: list[tuple[int, int]] = []
    for i in np.flatnonzero(sums[SPAN:] - sums[:-SPAN] >= 0).tolist() if ends else ():
        # N-gram i reaches from piece i - 2 to piece i.
        begin, end = ends[i - PIECES] if i >= PIECES else 0, ends[min(len(ends), i + SPAN) - 1]
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def natural_counts(docs: DataFrame, text: str) -> tuple[np.ndarray, np.ndarray]:
    """How often each bucket's n-grams of characters, and each bucket's of shapes, stand in the sentences of the whole
    corpus. A sentence without any mark of slots counts as many shapes without one as it has characters."""
    size = BUCKETS + SHAPES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(size, np.int64)
        for batch in batches:
            for part in _chunks(batch.column(0).to_pylist()):
                all_ = [s for t in part if t for s in sentences(t)]
                n[:BUCKETS] += np.bincount(_Grams([plain(s) for s in all_]).buckets, minlength=BUCKETS)
                marked = [_shape_grams(shape(s)[0]) for s in all_ if _HINT.search(s)]
                n[BUCKETS:] += np.bincount(np.concatenate(marked), minlength=SHAPES) if marked else 0
                n[BUCKETS] += sum(len(s) for s in all_ if not _HINT.search(s))
        at = np.flatnonzero(n)
        for i in range(0, len(at), 1 << 16):
            k = at[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(n[k])], ["bucket", "n"])

    rows = docs.select(text).mapInArrow(count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out[:BUCKETS], out[BUCKETS:]


def _log_model(counts: np.ndarray) -> np.ndarray:
    total = counts.sum()
    return np.log((1 - UNIFORM) * (counts / total if total else counts) + UNIFORM / BUCKETS)


def log_ratios(natural: np.ndarray) -> np.ndarray:
    """Rows: log-ratio of dummy Latin, of other filler and of notices to natural prose, by bucket. Dummy Latin stands in
    any order, so its model reads each two of its words."""
    latin = LOREM.split()
    rows = []
    for seeds in ([f"{a} {b}" for a in latin for b in latin], [plain(s) for s in sentences(FILLER)] + [f.replace("KIND", k) for k in KINDS.split(";") for f in re.split(r"[;\n]", FORMS.strip())], [plain(s) for s in sentences(NOTICES)]):
        rows.append(_log_model(np.bincount(_Grams(seeds).buckets, minlength=BUCKETS)) - _log_model(natural))
    return np.array(rows, np.float32)


def inspect(texts: list[str | None], ratios: np.ndarray, shapes: np.ndarray | None = None) -> list[tuple[int, int, int, bool]]:
    """(slots, residue characters, other characters, excluded) of each document. Quotations are no residue."""
    found, kept, owner, whole = [0] * len(texts), [], [], []
    for i, t in enumerate(texts):
        for s, bare, unfilled in _read(t, shapes) if t else ():
            found[i] += len(unfilled)
            if not chrome(s):
                kept.append(plain(bare))
                owner.append(i)
                whole.append(len(plain(s)))
    shares = _Grams(kept).shares(ratios) * np.array([len(k) / max(1, w) for k, w in zip(kept, whole)]) if kept else []
    residue, other, beside = [0] * len(texts), [0] * len(texts), [0] * len(texts)
    for i, size, share in zip(owner, whole, shares):
        if share >= SENTENCE and size >= LEAST:
            residue[i] += size
        else:
            other[i] += size
            beside[i] += 1
    out = []
    for n, r, o, k in zip(found, residue, other, beside):
        covered = r and (r >= COVERAGE * (r + o) or k <= FEW and o <= LITTLE)
        out.append((n, r, o, bool(n or covered)))
    return out


def residues(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, slots, residue, other, excluded) of every document: the number of unfilled slots, the characters in
    sentences of filler, error pages and script notices, those in other sentences but menus, and whether the
    document is to be excluded. Null and empty texts hold none and stay."""
    natural, shapes = natural_counts(docs, text)
    models = docs.sparkSession.sparkContext.broadcast((log_ratios(natural), slot_ratios(shapes)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios, marks = models.value
        for batch in batches:
            found = [x for part in _chunks(batch.column(1).to_pylist()) for x in inspect(part, ratios, marks)]
            n, residue, other, excluded = zip(*found) if found else ((), (), (), ())
            out = [batch.column(0), pa.array(n, pa.int32()), pa.array(residue, pa.int64()), pa.array(other, pa.int64()), pa.array(excluded, pa.bool_())]
            yield pa.RecordBatch.from_arrays(out, ["id", "slots", "residue", "other", "excluded"])

    kind = docs.schema[doc_id].dataType.simpleString()
    out = docs.select(doc_id, text).mapInArrow(read, f"id {kind}, slots int, residue bigint, other bigint, excluded boolean")
    return out.withColumnRenamed("id", doc_id)


def excluded(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id) of the documents to exclude."""
    return residues(docs, doc_id, text).where("excluded").select(doc_id)
