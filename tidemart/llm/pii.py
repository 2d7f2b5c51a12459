"""Personal data by patterns, and terms that give it away by information-theoretic sanitisation.

Patterns find protected entities, and so does the information of a token's own characters: a long
run of letters and digits in turn is a secret.  An entity is protected as a value (one address) and
as its kind (that there is a secret at all).  Over all documents, the share of a term's documents
that hold an entity says how much doubt the term leaves about it.  That share is taken at its lower
confidence bound, so a term must be seen often enough, and ever more surely the rarer it is.  A term
that leaves less doubt than a set number of bits, of an entity that is not common knowledge, is
disclosive; it is generalised in every text that holds it, with or without the entity.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.bytewords import Hasher, byte_set, lots, strings, words_of
from tidemart.llm.common import text_or_empty, written

KINDS = ("email", "ip", "card", "phone", "secret", "term")
# Doubt (in bits) about an entity below which a term discloses it, and what is common knowledge anyway.
DOUBT = 1.0
COMMON = 2.0
# Deviations by which a share is lowered (one-sided 90 %).
SURE = 1.28
LEAST_LETTERS = 3
# Of a secret: characters, bits of its own characters, and the share of them that change between letter and digit.
SECRET_LENGTH, SECRET_BITS, SECRET_TURNS = 20, 64.0, 0.2
# Bits of the table by which scans leave out most terms that nobody asks for: a fixed size.
SLOTS = 1 << 23
# Texts a task turns into strings at once.
ROWS = 250

# The patterns of the kinds.  A local part is read backwards from its `@`, which finds
# the same leftmost matches in linear time; so does the look-behind before a run of digits.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % SECRET_LENGTH)
_TURN = re.compile(r"(?:(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z]))")
_NO_TERM = ~byte_set((65, 90), (97, 122), (128, 255))
_NO_DIGIT = str.maketrans("", "", " -().+")


def emails(text: str) -> list[tuple[int, int]]:
    found, end = [], 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            end = m.end()
            found.append((start, end))
    return found


def luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[::-2]))) % 10 == 0


def secrets(text: str, found: dict[str, list[tuple[int, int]]]) -> list[tuple[int, int]]:
    """Tokens whose characters hold many bits, outside the spans of the kinds found before."""
    taken = any(found.values())

    def random_like(token: str) -> bool:
        if len(_TURN.findall(token)) < SECRET_TURNS * len(token):
            return False
        n = len(token)
        return sum(-c * math.log2(c / n) for c in Counter(token).values()) >= SECRET_BITS

    free = without_spans(text, found) if taken else text
    return [m.span() for m in _TOKEN.finditer(free) if m[0] and random_like(m[0])]


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans (code points, end exclusive) of the four kinds; matches that fail a test are dropped.

    Secrets have an entry only in a text that holds some; asked for in another, there are none.
    """
    def kept(pattern: re.Pattern, good) -> list[tuple[int, int]]:
        return [m.span() for m in pattern.finditer(text) if good(m[0])]

    def card(found: str) -> bool:
        digits = found.translate(_NO_DIGIT)
        return 13 <= len(digits) <= 19 and luhn(digits)

    found = defaultdict(list, {
        "email": emails(text),
        "ip": kept(_IP, lambda found: all(len(p) < 4 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in found.split(".")))),
        "card": kept(_CARD, card),
        "phone": kept(_PHONE, lambda found: 9 <= len(found.translate(_NO_DIGIT)) <= 15),
    })
    if own := secrets(text, found):
        found["secret"] = own
    return found


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def without_spans(text: str, by: dict[str, list[tuple[int, int]]]) -> str:
    """The text with blanks for the spans, so that what is left keeps its places."""
    out, at = [], 0
    for a, b in sorted(span for spans in by.values() for span in spans):
        if b > at:
            out += [text[at:max(a, at)], " " * (b - max(a, at))]
            at = b
    return "".join(out) + text[at:] if out else text


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few rows at a time, so that a task holds few texts as strings."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _terms(texts: list[str], least: int, hasher: Hasher):
    """Lots of the texts, with the terms of `least` letters and their places in code points."""
    for lot in lots(pa.array(texts, pa.string())):
        words = words_of(lot, _NO_TERM)
        point = np.concatenate([[0], np.cumsum((lot.data & 0xC0) != 0x80)])
        begin = point[lot.ends - lot.sizes - 1][words.text] if len(words.text) else words.text
        start, end = point[words.start] - begin, point[words.end] - begin
        long = end - start >= least
        words.start, words.end, words.text = words.start[long], words.end[long], words.text[long]
        yield lot, words, start[long], end[long], hasher(lot.data, words.start, words.end)


_SCAN = ("print long, doc_id long, n_email long, n_ip long, n_card long, n_phone long, n_secret long, base string,"
         " base_sha256 string, secrets string, entities array<string>, terms array<string>")


def _scan(least: int):
    """Spans and entities of each text; of those with entities also the distinct terms."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in parts(batches):
            counts, bases, secret, entities, terms = [], [], [], [], []
            for value in batch.column(2):
                text = value.as_py()
                by = base_spans(text)
                counts.append([len(by[k]) for k in KINDS[:5]])
                bases.append(joined([(k, a, b) for k in KINDS[:4] for a, b in by[k]]))
                secret.append(joined([("secret", a, b) for a, b in by["secret"]]))
                entities.append(sorted({f"{k}:{text[a:b].lower()}" for k, spans in by.items() for a, b in spans}
                                       | {f"{k}:" for k, spans in by.items() if spans}))
                held = []
                if entities[-1]:
                    for lot, words, *_ in _terms([without_spans(text, by)], least, hasher):
                        held = sorted(set(strings(lot.data, words.start, words.end).to_pylist()))
                terms.append(held)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array([c[i] for c in counts], pa.int64()) for i in range(5)],
                 pa.array(bases, pa.string()), pa.array([hashlib.sha256(b.encode()).hexdigest() for b in bases], pa.string()),
                 pa.array(secret, pa.string()), pa.array(entities, pa.list_(pa.string())), pa.array(terms, pa.list_(pa.string()))],
                ["print", "doc_id", "n_email", "n_ip", "n_card", "n_phone", "n_secret", "base", "base_sha256", "secrets", "entities", "terms"])

    return scan


def _slot(hashes: np.ndarray, size: int) -> np.ndarray:
    return (hashes >> np.uint64(20)) % np.uint64(size)


def _slots(size: int):
    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for lot in lots(batch.column(0)):
                own = hasher(lot.data, lot.ends - lot.sizes - 1, lot.ends - 1)
                yield pa.RecordBatch.from_arrays([pa.array(_slot(own, size).astype(np.int64))], ["slot"])

    return slots


def asked_slots(terms: DataFrame, size: int = SLOTS) -> np.ndarray:
    """A table of bits, set for the terms; it can be set for others, and its size is fixed."""
    found = terms.select("term").mapInArrow(_slots(size), "slot long").distinct().toArrow()
    table = np.zeros(size, bool)
    table[found.column("slot").to_numpy()] = True
    return np.packbits(table)


def _frequencies(bits: np.ndarray, least: int):
    """Of each lot, in how many texts the terms in the table stand."""
    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, hasher = np.unpackbits(bits).view(bool), Hasher()
        for batch in parts(batches):
            texts = [without_spans(t, base_spans(t)) for t in batch.column(0).to_pylist()]
            for lot, words, _, _, own in _terms(texts, least, hasher):
                asked = np.flatnonzero(table[_slot(own, len(table))])
                # Once per text; then equal terms side by side, told apart by their bytes where they leave the task.
                order = asked[np.lexsort((words.text[asked], own[asked]))]
                h, text = own[order], words.text[order]
                new = np.concatenate([np.ones(min(len(h), 1), bool), (h[1:] != h[:-1]) | (text[1:] != text[:-1])])
                order, h = order[new], h[new]
                first = np.flatnonzero(np.concatenate([np.ones(min(len(h), 1), bool), h[1:] != h[:-1]]))
                head = order[first]
                yield pa.RecordBatch.from_arrays(
                    [strings(lot.data, words.start[head], words.end[head]), pa.array(np.diff(np.append(first, len(h))).astype(np.int64))],
                    ["term", "df"])

    return frequencies


def lowest_share(both: Column, df: Column) -> Column:
    """Wilson's lower bound of the share both / df."""
    p, z2 = both / df, SURE * SURE
    return (p + z2 / (2 * df) - SURE * F.sqrt(p * (1 - p) / df + z2 / (4 * df * df))) / (1 + z2 / df)


def least_support(doubt: float) -> int:
    """How often a term must be seen with an entity if it is never seen without."""
    k = 1
    while 1 / (1 + SURE * SURE / k) < 2.0 ** -doubt:
        k += 1
    return k


def disclosive(found: DataFrame, texts: DataFrame, doubt: float = DOUBT, common: float = COMMON,
               least_letters: int = LEAST_LETTERS) -> DataFrame:
    """term: those that leave less than `doubt` bits about an entity of more than `common` bits.

    All counts are of documents, and each is written before it is joined.  Entities that stand in the
    same documents are one class, so a list of a thousand addresses is one entity to its terms.
    """
    documents = found.count()
    support = least_support(doubt)
    # Rows alike in doc_id and text are one row here, of weight m.
    bags = written(found.filter(F.size("entities") > 0).groupBy("print").agg(
        F.first("entities").alias("entities"), F.first("terms").alias("terms"), F.count(F.lit(1)).alias("m")), "entity-bags")
    held = bags.select("print", "m", F.explode("entities").alias("entity"))
    entities = (held.groupBy("entity").agg(F.sum("m").alias("df_entity"), F.bit_xor("print").alias("x"), F.bit_xor(F.xxhash64("print")).alias("y"))
                .filter((F.col("df_entity") >= support) & (F.col("df_entity") * 2.0 ** common < documents)))
    entities = written(entities.withColumn("kind", F.xxhash64("df_entity", "x", "y")).select("entity", "kind", "df_entity"), "entities")
    classes = written(held.join(entities.hint("merge"), "entity").select("print", "m", "kind", "df_entity").distinct(), "entity-classes")
    words = bags.join(classes.select("print").distinct().hint("merge"), "print", "left_semi").select("print", "m", F.explode("terms").alias("term"))
    wanted = written(words.groupBy("term").agg(F.sum("m").alias("held")).filter(F.col("held") >= support), "term-candidates")
    frequencies = written(
        texts.select("text").mapInArrow(_frequencies(asked_slots(wanted), least_letters), "term string, df long")
        .groupBy("term").agg(F.sum("df").alias("df")), "term-frequencies")
    # A term in too many documents for any entity is dropped before it meets them.
    most = entities.agg(F.max("df_entity")).first()[0] or 0
    rare = written(wanted.join(frequencies.hint("merge"), "term").filter(F.col("df") <= most * 2.0 ** doubt).select("term", "df"), "terms")
    both = (words.join(rare.hint("merge"), "term").join(classes.drop("m").hint("merge"), "print")
            .filter(F.col("df") <= F.col("df_entity") * 2.0 ** doubt)
            .groupBy("term", "kind", "df").agg(F.sum("m").alias("both")))
    return written(both.filter(lowest_share(F.col("both"), F.col("df")) >= 2.0 ** -doubt).select("term").distinct(), "disclosive-terms")


def _marks(bits: np.ndarray, least: int):
    """Places of the terms in the table, of texts that hold any."""
    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, hasher = np.unpackbits(bits).view(bool), Hasher()
        for batch in parts(batches):
            texts = [without_spans(t, base_spans(t)) for t in batch.column(1).to_pylist()]
            prints, upto = batch.column(0).to_numpy(), 0
            for lot, words, start, end, own in _terms(texts, least, hasher):
                at = np.flatnonzero(table[_slot(own, len(table))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(prints[upto + words.text[at]]), strings(lot.data, words.start[at], words.end[at]),
                     pa.array(start[at].astype(np.int32)), pa.array(end[at].astype(np.int32))], ["print", "term", "start", "end"])
                upto += len(lot.sizes)

    return marks


# Parts a hot term's places are dealt out in.
_SALTS = 16


def personal_data(docs: DataFrame, doubt: float = DOUBT, common: float = COMMON,
                  least_letters: int = LEAST_LETTERS) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_secret, n_term, n_private, print: a
    row for every row of `docs`.

    `base_sha256` is of the spans of the first four kinds; `spans` names all, secrets and disclosive
    terms after those, and n_private counts them.  Terms are words of ASCII letters and all beyond ASCII,
    A-Z lower-cased, outside the other spans.  Null text counts as empty: no spans.  Each row is a
    document in the counts; rows alike get the same spans.  Only doc_id and text are read.
    """
    source = docs.select(F.xxhash64("doc_id", "text").alias("print"), F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    found = written(source.mapInArrow(_scan(least_letters), _SCAN), "personal-data")
    bad = disclosive(found, source, doubt, common, least_letters)
    salt = F.pmod(F.xxhash64("print", "start"), F.lit(_SALTS)).cast("int")
    places = (source.select("print", "text").mapInArrow(_marks(asked_slots(bad), least_letters), "print long, term string, start int, end int")
              .withColumn("salt", salt)
              .join(bad.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))).hint("merge"), ["term", "salt"])
              .groupBy("print").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("terms"))
              .withColumn("n_term", F.size("terms").cast("long"))
              .withColumn("terms", F.array_join(F.transform(
                  "terms", lambda t: F.concat_ws(":", F.lit("term"), t.start, t.end)), ",")))
    some = lambda c: F.when(F.col(c) != "", F.col(c))
    n_term = F.coalesce("n_term", F.lit(0)).cast("long")
    return found.drop("entities", "terms").join(places.hint("merge"), "print", "left").select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256",
        F.concat_ws(",", some("base"), some("secrets"), "terms").alias("spans"),
        "n_secret", n_term.alias("n_term"),
        (F.col("n_email") + F.col("n_ip") + F.col("n_card") + F.col("n_phone") + F.col("n_secret") + n_term).alias("n_private"), "print")


def sanitised(docs: DataFrame, **settings) -> DataFrame:
    """The rows of `docs`, all columns, with every span replaced by its kind in brackets.

    Where spans overlap, the first of them names the whole run.
    """
    spans = personal_data(docs, **settings).filter("spans <> ''").select("print", "spans").distinct()
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
                       F.xxhash64("doc_id", "text").alias("print"))

    @F.pandas_udf("string")
    def replaced(texts, found):
        return texts.combine(found, mask)

    both = held.join(spans, "print", "left")
    text = F.when(F.col("spans").isNull(), F.col("_doc.text")).otherwise(replaced(F.col("_doc.text"), F.col("spans")))
    return both.withColumn("_doc", F.col("_doc").withField("text", text)).select("_doc.*")


def mask(text: str | None, spans: str | None) -> str | None:
    if not text or not spans:
        return text
    out, at = [], 0
    for a, b, kind in sorted((int(s[1]), int(s[2]), s[0]) for s in (x.split(":") for x in spans.split(","))):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]
