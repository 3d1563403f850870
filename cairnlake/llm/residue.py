"""Template residue, filler, error pages and demands for scripts.

Nothing is known of the wording beforehand; what is looked for is induced from all texts.

* *Slots.* Marks that may be an unfilled field, leftover code, a default or a
  blank are located, and the words around each are masked (digits) into a
  context. Records that share a context are aligned on it: where their marks
  differ, or where another record has the place filled, it is a slot and the
  mark an unfilled one; where the records of several dockets all carry the same
  mark and no record fills the place, it is wording of the template itself (a
  decision that discusses a field), no slot. A mark whose own context aligns
  with nothing is found only in a notation that induced slots have. Marks in
  quotation marks are mentions and dropped at once.
* *Pages.* Texts without numbered paragraphs are no decisions. Texts of either
  kind are cut into units (lines, sentences and their parts, digits masked); a
  unit of a decision is looked at if all its words occur in such pages over
  ``PAGE`` dockets. Its keys (the unit, its runs of three words, its words)
  are page wording if ``PAGE`` dockets of pages have them and pages have them
  ``LIFT`` times as often as decisions. A unit of which page wording accounts
  for ``COVERED`` of the words is residue: an error message, a demand for
  scripts or filler, in any language, as a page or among the paragraphs.
  Quoting units are mentions.
* *Repeats.* Units of a few words over and over, or of one sentence repeated.

Contexts and units are counted over all documents with map-side combined
aggregates; versions and copies of one ruling count once, by docket (where
there is none, by document) and by the letters of their surroundings. Workers
hold the page words as a bit filter of fixed size, which only preselects: what
it lets through is counted and joined exactly. The contexts of one agreed mark
are held by the driver and every worker; nothing else is. Odd cases: null,
empty and blank texts are never found; repeated rows are found again under
their id; an empty table gives an empty result; redactions (``[REDACTED]``,
``X.____``, blacked words) and signature lines are no marks. A corpus without
repeated pages teaches no page wording: there only slots and repeats are found.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from operator import eq

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Dockets of texts without paragraphs that must share a word or run of words before it may be of a page template.
PAGE = 2
#: How many times as often as decisions the texts without paragraphs have what belongs to page templates.
LIFT = 5
#: Share of a unit's words that page templates must account for.
COVERED = 0.6
#: Bits of the filter of page words that every worker holds (a megabyte).
FILTER_BITS = 1 << 23
#: Share of a mark's dockets that have it as constant wording, from which it is wording at its other places that are never filled.
WORDING = 0.8
#: Characters that a filled place may hold.
FILLING = 80
#: Characters on either side of a context's word that hold the whole place.
REACH = 2 * 48 + FILLING + 40

# Words that ask for a field to be filled, in the corpus's languages.
ASK = r"insert|enter|to be (?:added|inserted|completed|confirmed)|tb[cda]\b|to follow|fill in|einfügen|eintragen|ergänzen|nachtragen|folgt|à compléter|compléter|insérer|à insérer|renseigner|insertar|completar|rellenar|indicar|por completar|●|placeholder|platzhalter"
_NUMBER = r"(?:¶ ?\d+|\[\d+\]|\(\d+\)|\d{1,4}\.(?!\d)|\d{1,4}\t)"
_PARAGRAPH = re.compile(rf"(?m)^\s*{_NUMBER}")
_LEAD = re.compile(rf"^\s*{_NUMBER}\s*")
_SENTENCES = re.compile(r"(?<=[.!?])\s+")
_QUOTE_OPEN, _QUOTE_CLOSE = set("\"“„«‚‘'»"), set("\"”“»’‘'«")
_ID = r"[^\W\d]\w*(?:\.\w+)*"

#: Marks: unfilled fields and leftover code in the notations of common template languages; defaults; blanks.
MARK = re.compile(
    rf"\{{\{{[^{{}}\n]{{1,80}}\}}\}}\}}?|[$#]\{{\s*[^{{}}\n]{{1,60}}\}}|\{{%[^{{}}\n]{{1,80}}%\}}|(?<![\w{{])\{{(?:{_ID}|\d{{1,3}})\}}|<%[^<>\n]{{0,80}}%>|<\?[^<>\n]{{0,80}}\?>"
    rf"|%\(\w+\)[sd]|(?<![\w%])%[A-Z][A-Z0-9_]{{2,}}%|@@\w+@@|##\w+##|\[\[[^\[\]\n]{{1,60}}\]\]|<<[^<>\n]{{1,60}}>>|&lt;[^&<>\n]{{2,60}}&gt;|\[(?:●|_{{2,}}|\s+)\]|«[A-Z]+_[A-Z0-9_]*»"
    rf"|<(?!/?noscript\b|\|)[^\W\d_][^<>\n|/=]{{2,60}}>|\[(?=[^\[\]\n]*(?i:{ASK}))[^\[\]\n]{{2,80}}\]|\((?=[^()\n]*(?i:enter|insert|einfügen|eintragen|compléter|insérer|insertar|completar|tbc|tbd)\b)[^()\n]{{4,80}}\)"
    r"|(?<![\w\[])\[object \w+\]|(?<!\w)#(?:REF!|N/A|VALUE!|NAME\?|NULL!|DIV/0!|NUM!)"
)
# Characters that marks start with; the plain words are looked for by themselves.
_START = re.compile(r"[{<@%«\[(#&]")
_ASKED = ("enter ", "insert", "insér", "compl", "tbc", "tbd", "hier ")
_WORDS = ("TODO", "FIXME", "NaN", "undefined", "null", "None", "TBC", "TBD", "XX")
_WORD_MARK = re.compile(r"(?<![\w.\-\[{<%@#(])(?:TODO|FIXME|NaN|undefined|null|None|TBC|TBD)(?![\w\-])(?! (?:und|and|of|et|y|der|the|ist|is)\b)|\bXX[./-]XX[./-](?:20)?XX(?:XX)?\b")
_SEE = re.compile(r"(?i)<(?:see|cf|siehe|voir|véase|ver)\b|</?(?:p|br|b|i|em|strong|div|span|a|table|tr|td|th|ul|ol|li|h\d|body|html|head|title|img|script|style)(?:\s[^<>]*)?/?>")
_WORD = re.compile(r"\w+")
_RUN = re.compile(r"(?i)\b([^\W\d]{2,30})(?:\s+\1\b){3}")
_PARTS = re.compile(r"(?<=[:…])\s+|\s[–|—]\s|</?\w+>")
_NUMBERED = set("¶[(0123456789")
_ODD_GAP = re.compile(r"[.!?](?=[^\S ])")
_PART_SIGN = re.compile("[:…–|—<]")
_LETTERS = re.compile(r"\b[^\W\d_]+\b")
_TOKEN = re.compile(r"\b[^\W\d_]+\b|\w*\d\w*|#")


def _over_and_over(words: list[str]) -> bool:
    return len(words) >= 6 and len(set(words)) <= 0.4 * len(words)


def _twice(parts: list[str]) -> bool:
    """Whether a sentence of at least two words and no digits directly follows itself."""
    return any(len(_WORD.findall(x)) >= 2 and not any(c.isdigit() for c in x) for x, same in zip(parts, map(eq, parts, parts[1:]), strict=False) if same)


def _mask(text: str) -> str:
    return re.sub(r"\d+", "#", text.casefold())


def _context(text: str, a: int, b: int) -> str:
    left = re.findall(r"[^\W\d]+|\d+|[^\w\s]", text[max(0, a - 48) : a])[-3:]
    right = re.findall(r"[^\W\d]+|\d+|[^\w\s]", text[b : b + 48])[:3]
    mask = lambda words: " ".join("#" if w[0].isdigit() else "N" if w[0].isupper() else w for w in words)
    return mask(left) + "\t" + mask(right)


def _passage(text: str, a: int, b: int) -> int:
    """The letters and digits around a place; line ends and scanning marks don't tell passages apart."""
    left, right = ("".join(c for c in part.casefold() if c.isalnum()) for part in (text[max(0, a - 160) : a], text[b : b + 160]))
    return hash_of(left[-60:] + "\x00" + right[:60])


#: A context with a word of its own (see ``_words_of``).
OWN_WORD = r"(?<!\S)(?!N(?!\S))\p{L}"


def _words_of(key: str) -> frozenset[str]:
    """The words of a context that are its own: no names, numbers and punctuation."""
    return frozenset(w for w in key.split() if w != "N" and w[0].isalpha())


def _aligned(key: str) -> re.Pattern:
    """Finds places that have the context around them; group 1 is what they hold."""
    letters = r"(?<![^\W\d])%s(?![^\W\d])"

    def side(words: str) -> str:
        return r"\s*".join(letters % r"(?![a-zß-öø-ÿ])[^\W\d]+" if w == "N" else r"(?<!\d)\d+(?!\d)" if w == "#" else letters % re.escape(w) if w[0].isalpha() else re.escape(w) for w in words.split())

    left, right = key.split("\t")
    return re.compile(rf"(?s){side(left)}\s*(\S.{{0,{FILLING - 1}}}?)\s*{side(right) or r'(?!.)'}")


def _is_filling(value: str) -> bool:
    return any(c.isalnum() for c in value) and not any(c in "{}<>[]@%«»#$" for c in value) and not _WORD_MARK.search(value)


def _fillings(keys: list[str]):
    """A scan that gives the contexts of ``keys`` that a text has with the place filled."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        # A context is looked for only in texts that hold all its words, the longest of them as the way in.
        words, by_word = ahocorasick.Automaton(), {}
        for key in keys:
            own = [w for w in dict.fromkeys(key.split()) if w not in ("N", "#")]
            by_word.setdefault(max(_words_of(key), key=lambda w: (len(w), w)), []).append((key, own, _aligned(key)))
        for w in by_word:
            words.add_word(w, w)
        words.make_automaton()
        left = set(keys)
        for b in batches:
            new = []
            for t in b["text"].to_pylist():
                at: dict[str, list[int]] = {}
                for end, w in words.iter(t) if t and left else ():
                    at.setdefault(w, []).append(end)
                for w, ends in at.items():
                    for key, own, how in [k for k in by_word[w] if k[0] in left and all(o in t for o in k[1])]:
                        # The parts of the text around the word; what is two parts' is one.
                        parts: list[list[int]] = []
                        for end in ends:
                            if parts and end - REACH <= parts[-1][1]:
                                parts[-1][1] = end + REACH
                            else:
                                parts.append([max(0, end - REACH), end + REACH])
                        if any(_is_filling(m[1]) for a, b in parts for m in how.finditer(t, a, len(t) if key.endswith("\t") else min(b, len(t)))):
                            left.discard(key)
                            new.append(key)
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string())], names=["key"])

    return scan


def _marks(text: str) -> Iterator[tuple[int, int]]:
    """Places of marks that are not in quotation marks."""
    spans, last = [], 0
    for m in _START.finditer(text):
        at = m.start()
        c = text[at]
        if at < last or c == "(" and not (text[at + 1 : at + 4].isupper() or text[at + 1 : at + 8].lower().startswith(_ASKED)) or c == "[" and text[at + 1 : at + 2].isdigit():
            continue
        if c == "{" and at and text[at - 1] in "$#":
            at -= 1
        if f := MARK.match(text, at):
            spans.append(f.span())
            last = f.end()
    if any(w in text for w in _WORDS):
        spans += [m.span() for m in _WORD_MARK.finditer(text)]
    for a, b in spans:
        if a and b < len(text) and text[a - 1] in _QUOTE_OPEN and text[b] in _QUOTE_CLOSE or _SEE.match(text[a:b]):
            continue
        yield a, b


def slots(text: str) -> list[tuple[str, str, int]]:
    """Context, masked mark and place of each mark of a text."""
    return [(_context(text, a, b), _mask(text[a:b]), _passage(text, a, b)) for a, b in _marks(text)]


def sentences(text: str) -> list[list[str]]:
    """The sentences of each line, in lower case and without paragraph numbers."""
    out = []
    for line in text.casefold().splitlines():
        if line[:1] in _NUMBERED or line[:1].isspace():
            line = _LEAD.sub("", line)
        if not line or line.isspace():
            continue
        out.append([p for p in _SENTENCES.split(line) if p and not p.isspace()] if ". " in line or "! " in line or "? " in line or _ODD_GAP.search(line) else [line])
    return out


def repeats(lines: list[list[str]]) -> bool:
    """Whether a line or a sentence says the same over and over."""
    for parts in lines:
        for p in parts:
            words = p.split()
            if _over_and_over(words) or any(map(eq, words, words[1:])) and _RUN.search(p):
                return True
        if len(parts) > 1 and (any(map(eq, parts, parts[1:])) and _twice(parts) or _over_and_over(" ".join(parts).split())):
            return True
    return False


def is_page(text: str) -> bool:
    """Whether a text has none of a decision's numbered paragraphs."""
    return not _PARAGRAPH.search(text)


def units(lines: list[list[str]]) -> Iterator[str]:
    """Sentences, lines of several, and the parts of sentences at dashes, colons and tags."""
    for parts in lines:
        if len(parts) > 1:
            yield " ".join(parts)
        for sentence in parts:
            yield sentence
            if _PART_SIGN.search(sentence) and len(pieces := _PARTS.split(sentence)) > 1:
                yield from (p for p in pieces if p and not p.isspace())


def masked(unit: str) -> list[str]:
    """A unit's words; those with digits are all one."""
    return [w if w.isalpha() else "#" for w in _TOKEN.findall(unit)]


def hash_of(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


_EVIDENCE = pa.schema([("doc_id", pa.int64()), ("docket", pa.string()), ("kind", pa.string()), ("key", pa.string()), ("mark", pa.string()), ("place", pa.int64())])
_DDL = "doc_id bigint, docket string, kind string, key string, mark string, place bigint"


def _rows_of(batch: pa.RecordBatch) -> Iterator[tuple[object, str, str, str]]:
    """(doc_id, docket, court, text) of the texts that aren't blank."""
    for i, t, d, c in zip(*(batch[n].to_pylist() for n in ("doc_id", "text", "docket", "court")), strict=True):
        if t and not t.isspace():
            yield i, d or f"document {i}", (c or "").casefold(), t


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


_PAGE_WORDS = pa.schema([("docket", pa.string()), ("word", pa.string()), ("pages", pa.int64()), ("bodies", pa.int64())])


def _page_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of texts without paragraphs, with the docket; and, as the word null, how many texts of either kind there are."""
    for b in batches:
        seen: set[tuple[str, str]] = set()
        n = [0, 0]
        for _, docket, court, text in _rows_of(b):
            page = is_page(text)
            n[not page] += 1
            if page:
                seen.update((docket, w) for u in units(sentences(text)) if u.strip() != court for w in masked(u) if w != "#")
        yield _table([(d, w, 0, 0) for d, w in seen] + [(None, None, *n)], _PAGE_WORDS)


def _filter_bits(keys: DataFrame, column: str) -> bytes:
    """A set of texts as bits by hash, of a fixed size whatever there is: members are always found, others hardly ever."""
    at = F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))
    words = keys.select(F.shiftright(at, 6).cast("int").alias("w"), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(at, F.lit(64)).cast("int")).alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    out = [0] * (FILTER_BITS // 64)
    for r in words.collect():  # at most FILTER_BITS / 64 numbers
        out[r["w"]] = r["b"] & (2**64 - 1)
    return struct.pack(f"<{len(out)}Q", *out)


def _member(bits: bytes):
    """Whether a word may be in the set; answers are remembered, for words repeat."""
    import xxhash

    known: dict[str, bool] = {"#": True}

    def test(word: str) -> bool:
        got = known.get(word)
        if got is None:
            if len(known) > 300_000:
                known.clear()
                known["#"] = True
            at = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 42)
            at = (at - (1 << 64) if at >> 63 else at) % FILTER_BITS
            got = known[word] = bool(bits[at >> 3] >> (at & 7) & 1)
        return got

    return test


def _gather(bits: bytes):
    """A scan that gives each text's marks and repeated wording, and its units that are made of page words alone."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may = _member(bits)
        inside: dict[str, tuple[str, ...]] = {}  # the page words of a token; tokens repeat
        for b in batches:
            rows: list[tuple] = []
            held: dict[str, int] = {}
            for i, docket, court, text in _rows_of(b):
                page, lines, mine = is_page(text), sentences(text), set()
                if repeats(lines):
                    rows.append((i, docket, "sure", None, None, None))
                rows += [(i, docket, "slot", *s) for s in slots(text)]
                known: set[str] = set()
                for token in set(text.casefold().split()):
                    found = inside.get(token)
                    if found is None:
                        if len(inside) > 300_000:
                            inside.clear()
                        found = inside[token] = tuple(w for w in _LETTERS.findall(token) if may(w))
                    known.update(found)
                if not page:
                    for w in known:
                        held[w] = held.get(w, 0) + 1
                for u in units(lines):
                    for w in u.split():  # most units end here, at one of their first words
                        if w.isalpha() and w not in known:
                            break
                    else:
                        letters = _LETTERS.findall(u)
                        if letters and known.issuperset(letters) and u not in mine and u.strip() != court:
                            mine.add(u)
                            rows.append((i, docket, "page" if page else "part", " ".join(masked(u)), None, int(_said(u))))
            rows += [(None, None, "held", w, None, n) for w, n in held.items()]
            yield _table(rows, _EVIDENCE)

    return scan


def _said(unit: str) -> bool:
    """Whether a unit stands in quotation marks, or is the rest of a sentence that quotes."""
    bare = unit.strip()
    return bare[:1] in _QUOTE_OPEN and bare[-1:] in _QUOTE_CLOSE or sum(bare.count(c) for c in '"“”„«»') > 0


def _keys(parts: DataFrame) -> DataFrame:
    """Each unit's keys with the words they cover: the unit itself, its runs of three words, its words."""
    w = F.split("key", " ")
    n = F.size("w")
    every = F.sequence(F.lit(0), n - 1)
    whole = F.array(F.struct(F.concat(F.lit("s "), F.col("key")).alias("k"), every.alias("at")))
    runs = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(F.concat(F.lit("g "), F.array_join(F.slice("w", i + 1, 3), " ")).alias("k"), F.sequence(i, i + 2).alias("at"))))
    words = F.transform("w", lambda x, i: F.struct(F.concat(F.lit("u "), x).alias("k"), F.array(i).alias("at")))
    return parts.withColumn("w", w).select("doc_id", "docket", "kind", "key", F.explode(F.flatten(F.array_compact(F.array(whole, runs, words)))).alias("e")).select("doc_id", "docket", "kind", "key", "e.k", "e.at")


def page_units(ev: DataFrame, n_pages: int, n_bodies: int) -> DataFrame:
    """``doc_id`` of texts with a unit of which the page templates account for most.

    A key (unit, run of three words, word) belongs to page templates if ``PAGE`` dockets of texts without
    paragraphs have it and these texts have it ``LIFT`` times as often as decisions. Words are counted in
    whole decisions, longer keys in their units made of page words.
    """
    parts = ev.where("kind in ('page', 'part') and place = 0")
    keys = _keys(parts)
    counted = keys.groupBy("k").agg(F.count_distinct(F.when(F.col("kind") == "page", F.col("docket"))).alias("dockets"), F.count_distinct(F.when(F.col("kind") == "page", F.col("doc_id"))).alias("pages"), F.count_distinct(F.when(F.col("kind") == "part", F.col("doc_id"))).alias("bodies"))
    held = ev.where("kind = 'held'").groupBy(F.concat(F.lit("u "), F.col("key")).alias("k")).agg(F.sum("place").alias("held"))
    typical = counted.where(F.col("dockets") >= PAGE).join(held, "k", "left").where(F.col("pages") * n_bodies >= LIFT * F.greatest("bodies", F.coalesce("held", F.lit(0))) * n_pages).where("k <> 'u #'").select("k")
    covered = keys.join(typical, "k", "left_semi").select("doc_id", "kind", "key", F.explode("at").alias("at")).distinct()
    covered = covered.where(F.get(F.split("key", " "), F.col("at")) != "#").groupBy("doc_id", "kind", "key").agg(F.count("*").alias("n"))
    own = F.size(F.filter(F.split("key", " "), lambda x: x != "#"))
    return covered.where(F.col("n") >= COVERED * own).where((own >= 2) | F.col("key").contains("#") | (F.col("kind") == "page")).select("doc_id").distinct()


def induced_slots(marks: DataFrame, cols: DataFrame) -> DataFrame:
    """``doc_id`` of texts with an unfilled slot.

    A context is a slot if records differ in what they have there: another mark, or a filled place. It is
    wording if the records of several dockets have one and the same mark there and none has it filled. Marks
    whose own context aligns with no other record are judged by what the slots taught: the mark itself, or
    its notation (the mark with its letters left out), must be that of an induced slot's.
    """
    own = marks.groupBy("key", "mark").agg(F.least(F.count_distinct("docket"), F.count_distinct("place")).alias("n"))
    per = own.groupBy("key").agg(F.sum("n").alias("n"), F.count("*").alias("marks"), F.min("mark").alias("mark")).checkpoint()
    single = per.where("marks = 1")
    agreed = single.where("n > 1").select("mark").distinct()  # alignment takes two
    asked = single.join(agreed, "mark", "left_semi").where(F.col("key").rlike(OWN_WORD)).select("key", "n").checkpoint()
    filled = _filled(asked, cols)
    never = asked.join(filled, "key", "left_anti").checkpoint()
    # A mark found nearly only as agreed wording is wording in its scanning variants, too, unless they are filled.
    said = own.join(never.where("n > 1").select("key", F.lit(True).alias("fixed")), "key", "left").groupBy("mark").agg((F.sum(F.when(F.col("fixed"), F.col("n")).otherwise(0)) >= WORDING * F.sum("n")).alias("said")).where("said")
    wording = never.where("n > 1").select("key").unionByName(single.join(never.select("key"), "key", "left_semi").join(said, "mark", "left_semi").select("key"))
    open_marks = marks.join(wording, "key", "left_anti")
    aligned = per.where("marks > 1").select("key").unionByName(filled.select("key"))
    notation = F.regexp_replace(F.regexp_replace("mark", r"[\p{L}\p{N}_#]+", "a"), r"(a\W{0,2})+a", "a")
    notation = F.when(notation == "a", F.col("mark")).otherwise(notation)  # a bare word has no notation
    taught = open_marks.join(aligned.distinct(), "key", "left_semi").select(notation.alias("notation")).distinct().checkpoint()
    by_own = open_marks.join(aligned.distinct(), "key", "left_semi").select("doc_id")
    by_notation = open_marks.withColumn("notation", notation).join(taught, "notation", "left_semi").select("doc_id")
    return by_own.unionByName(by_notation).distinct()


def _filled(asked: DataFrame, cols: DataFrame) -> DataFrame:
    """The contexts of ``asked`` that some text has with the place filled."""
    keys = [r["key"] for r in asked.select("key").collect()]
    return cols.select("text").mapInArrow(_fillings(keys), "key string").distinct().checkpoint() if keys else asked.select("key").limit(0)


def judged(documents: DataFrame) -> DataFrame:
    """``doc_id`` of each text with residue, one row each."""
    cols = documents.select("doc_id", "text", *[F.col(c) if c in documents.columns else F.lit(None).cast("string").alias(c) for c in ("court", "docket")])
    words = cols.mapInArrow(_page_words, "docket string, word string, pages bigint, bodies bigint").groupBy("word").agg(F.count_distinct("docket").alias("dockets"), F.sum("pages").alias("pages"), F.sum("bodies").alias("bodies")).checkpoint()
    total = words.where("word is null").first()
    n_pages, n_bodies = (total["pages"], total["bodies"]) if total else (0, 0)
    bits = _filter_bits(words.where("word is not null").where(F.col("dockets") >= PAGE), "word")
    ev = cols.mapInArrow(_gather(bits), _DDL).checkpoint()  # read several times below; a few rows per suspicious text
    sure = ev.where("kind = 'sure'").select("doc_id")
    return sure.unionByName(induced_slots(ev.where("kind = 'slot'"), cols)).unionByName(page_units(ev, n_pages, n_bodies)).distinct()
