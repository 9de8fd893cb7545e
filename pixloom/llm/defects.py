"""Defective question-answer pairs (problem 4): empty, truncated, refusal, copies_question, other_language.

Language is a naive-Bayes posterior over whole words and their letter n-grams, trained on the rows
themselves with the language columns as weak labels. Whether a text without a closing mark breaks
off is an end-of-text likelihood: of all places in the corpus where the last one to ``CONTEXT``
words stand together, the share at which a sentence ends; the longest context seen decides. A last
word seen nowhere but as the beginning of others breaks off. Refusals are first-person or impersonal
formulas outside quotations; copies are found by aligning the words of answer and question.

Plan. The distinct texts of each language are counted once each: one shuffle of texts, then one Arrow pass that
counts words and contexts inside its task, so the next shuffle carries vocabularies. The language model is
cut to ``MAX_GRAMS`` and broadcast; context counts stay distributed and are joined with the undecided texts only, by hash.

Defined results: null is empty; all comparisons read the canonical character forms; a pair has one
defect, the first of empty, copies_question, refusal, other_language, truncated; repeated rows count
once; a row stored with several answers has each of their defects; texts of any length are read whole.
"""

from __future__ import annotations

import difflib
import functools
import math
import re
import unicodedata
from collections import Counter

import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixloom.llm import textforms
from pixloom.session import cut, spread, table

#: Words of the longest context; a Chinese character is a word.
CONTEXT = 2
#: Most features of the broadcast language model.
MAX_GRAMS = 120_000
#: Least log-odds of another language against the question's.
LANGUAGE_MARGIN = 3.0
#: A context that ends a sentence less often than this is open.
END_SHARE = 0.01

_CODES = {"eng": "en", "chi": "zh", "zho": "zh", "spa": "es", "ger": "de", "deu": "de", "fra": "fr", "fre": "fr"}
_TAG = re.compile(r"<[^<>]*>")
_TOKEN = regex.compile(r"\p{Han}|[[\p{L}\p{M}\p{N}'’]--\p{Han}](?:[[\p{L}\p{M}\p{N}'’\-]--\p{Han}]*[[\p{L}\p{M}\p{N}]--\p{Han}])?|[.!?。]+|\n", regex.V1)
#: A number with its unit.
_MEASURE = regex.compile(r"\p{N}+[\p{N}.,]*\s*(?:\p{L}{1,2}|khz|mhz|ghz|hz)?[²³]?(?![\p{L}\p{N}])", regex.I)
_HAN = regex.compile(r"\p{Han}")
_CLOSED = re.compile(r"[.!?。][\"'”’“»)\]』」*_`\s]*$")
_OPEN_END = re.compile(r"[,:;(\[{、–—-]\s*$")
_QUOTED = re.compile(r"\"[^\"]*\"|“[^”]*”|„[^“”]*[“”]|«[^»]*»|「[^」]*」|『[^』]*』")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|(?<=。)|(?<=[!?])(?=[㐀-鿿])|\n+")

#: Words after which no text ends.
_LEADS = re.compile(
    r"(?:\b(?:a|an|the|of|and|or|which|whose|because|because of|as well as|such as|for example|while|whereas|than|with|from|between"
    r"|und|oder|sowie|weil|der|das|ein|eine|einer|einem|eines|dass|zum beispiel|wobei|mit"
    r"|que|y|o|el|la|los|las|un|una|de|del|porque|como|por ejemplo|mientras|con|cuyo|cuya)"
    r"|以及|因为|并且在|并且|例如|旁边的|而且|或者|比如|其中)\s*$"
)
#: Most words of a bare phrase.
_PHRASE = 8

_INTRO = re.compile(
    r"^(?:(?:so\s+)?(?:you(?: are|'re)? ask(?:ing|ed)?|your question(?: is| was)?|the question(?: is| was)?|question|q)"
    r"|(?:sie|du) frag(?:en|st)|(?:ihre|deine|die) frage(?: lautet| ist)?|frage|usted pregunta|(?:me )?preguntas|(?:su|tu|la) pregunta(?: es)?|pregunta"
    r"|[您你](?:问|在问)的是|[您你]的问题是|问题(?:是)?)\s*:\s*"
)

_FIRST_PERSON = re.compile(r"\b(?:i|we|i'\w+|my|no (?:image|picture|photo)|ich|mir|meine?n?|no|me|mis|debo|tengo|prefiero|rechazo)\b|[我本恕]|无法|拒绝|没有收到")
_REFUSALS = [
    re.compile(p)
    for p in (
        # English
        r"\b(?:i|we)(?: am|'m| are|'re)? (?:(?:can|could|may|must|shall|will|would|do|did)(?: ?not|n't)|can't|won't|(?:am |'m )?(?:not able|unable|not allowed|not permitted))\b"
        r".*\b(?:answer|help|assist|view|see|describe|discuss|comment|inspect|identify|provide|access|open|process|look|comply|say|tell|respond|analy[sz]e|fulfil+)\b",
        r"\bi(?:'m| am) (?:not able|unable|not allowed|not permitted) to\b",
        r"\bi(?: must| have to| need to|'ll have to)? (?:respectfully )?(?:decline|refuse)\b|\bi(?:'d| would) rather not\b|\bi prefer not to\b",
        r"\bquestion\b.*\bi have to leave open\b|\b(?:outside|beyond) what i(?: am|'m) (?:allowed|able|permitted)\b|\bagainst my (?:guidelines|policy|policies|rules|principles)\b",
        r"\bno (?:image|picture|photo)\b.*\b(?:reached|attached|provided|received|available|uploaded)\b|\bi (?:do not|don't) (?:have access|see any (?:image|picture))\b",
        # German
        r"\b(?:kann|darf|möchte|werde|könnte)\b.*\bich\b.*\b(?:nicht|keine?n?)\b|\bich (?:kann|darf|möchte|werde|könnte)\b.*\b(?:nicht|keine?n?)\b",
        r"\bich\b.*\bablehnen\b|\blehne ich\b.*\bab\b|\bich lehne\b.*\bab\b|\bfehlt mir die möglichkeit\b|\bmir\b.*\bkein bild\b|\bbin ich nicht in der lage\b|\bich bin nicht in der lage\b|\b(?:ver|ge)(?:weigere|gen meine richtlinien)\b",
        # Spanish
        r"\bno (?:puedo|podré|podría)\b.*\b(?:\w+r(?:le|les|lo|la|te)?)\b|\bno me (?:es posible|está permitido)\b|\b(?:debo|tengo que) (?:rechazar|declinar)\b|\bprefiero no\b|\bno tengo (?:acceso|permitido|permiso)\b|\bme niego\b|\brechazo (?:esta|la)\b|\bcontra mis (?:normas|directrices|reglas)\b|\bno (?:me )?ha llegado ninguna imagen\b|\bno (?:recibí|he recibido) ninguna imagen\b",
        # Chinese
        r"[我本](?:们)?[^。]*(?:无法|不能|不便|没法|没有办法|看不到|拒绝|不可以|无权|不会)|恕难|恕不|恕我|无法回答|拒绝(?:评论|回答)|没有收到[^。]*图",
    )
]

_REQUESTS = {
    "zh": r"\bin (?:simplified |traditional )?(?:chinese|mandarin)\b|\bauf chinesisch\b|\ben chino\b|[用以](?:中文|汉语|普通话)",
    "de": r"\bin german\b|\bauf deutsch\b|\ben alemán\b|[用以](?:德语|德文)",
    "es": r"\bin spanish\b|\bauf spanisch\b|\ben (?:español|castellano)\b|[用以](?:西班牙语|西班牙文)",
    "en": r"\bin english\b|\bauf englisch\b|\ben inglés\b|[用以](?:英语|英文)",
    "fr": r"\bin french\b|\bauf französisch\b|\ben francés\b|[用以](?:法语|法文)",
}
_REQUESTS = {lang: re.compile(p) for lang, p in _REQUESTS.items()}


def language_code(lang) -> str | None:
    if not isinstance(lang, str) or not lang.strip():
        return None
    code = re.split(r"[-_]", lang.strip().lower())[0]
    return _CODES.get(code, code)


@functools.lru_cache(maxsize=20_000)
def requested(question: str) -> frozenset[str]:
    """Languages that a question (in canonical form) asks for."""
    return frozenset(lang for lang, p in _REQUESTS.items() if p.search(question))


def plain(text: str) -> str:
    """Canonical characters, lower case."""
    return textforms.skeleton(text).casefold().replace("’", "'")


_plain = functools.lru_cache(maxsize=20_000)(plain)


def is_empty(text: str | None) -> bool:
    if text is None:
        return True
    bare = _TAG.sub(" ", unicodedata.normalize("NFKC", textforms.fold(text)))
    return not any(ch.isalnum() for ch in bare)


def _strip_intro(text: str) -> str:
    text = re.sub(r"^[\s\-*#>\"'“„«`_]+", "", _TAG.sub(" ", text))
    return _INTRO.sub("", text, count=1)


def copies(question: str, answer: str) -> bool:
    """Both in plain form: the answer is nothing but (most of) the question."""
    q = textforms.words(question)
    if len(q) < 3 or len(answer) < 0.5 * len(question):
        return False
    a = textforms.words(_strip_intro(answer))
    if len(a) < 0.65 * len(q) or len(set(q) & set(a)) < 0.65 * len(set(q)):
        return False
    rest, covered = a, 0.0
    while rest:
        blocks = [b for b in difflib.SequenceMatcher(None, q, rest, autojunk=False).get_matching_blocks() if b.size > 1]
        held = sum(b.size for b in blocks)
        cover = held / len(q)
        if cover < 0.7 and not (covered and held >= 0.9 * len(rest)):
            break
        covered = max(covered, cover)
        used = {i for b in blocks for i in range(b.b, b.b + b.size)}
        rest = [w for i, w in enumerate(rest) if i not in used]
    if covered < 0.7:
        return False
    # the last word may be cut within
    if rest and rest[-1:] == a[-1:] and any(w.startswith(rest[-1]) for w in q):
        rest = rest[:-1]
    return len(rest) <= max(1, 0.1 * len(q)) and len(rest) <= 0.1 * len(a) + (len(a) >= 8)


def refuses(answer: str) -> bool:
    """In plain form: one of the first two sentences, quotations aside, declines."""
    if not _FIRST_PERSON.search(answer):
        return False
    bare = _QUOTED.sub(" ", answer)
    said = [s for s in _SENTENCE.split(bare) if s and s.strip()][:2]
    return any(p.search(s) for s in said if not re.search(r"\b(?:reads|says|lautet|dice|steht)\s*:", s) for p in _REFUSALS)


def language_words(text: str) -> list[str]:
    """Words that have a language: no numbers, codes, single letters or markup."""
    text = _MEASURE.sub(" ", _TAG.sub(" ", text))
    return [w for w in textforms._ANY_WORDS(text) if _HAN.match(w) or (len(w) > 1 and w.isalpha())]


def grams(word: str) -> list[str]:
    if _HAN.match(word):
        return [word]
    w = f"^{word}$"
    return [f"={word}", *(w[i : i + n] for n in (2, 3, 4) for i in range(len(w) - n + 1))]


class Languages:
    """Naive-Bayes posterior of a text; ``counts`` maps a feature to its count in each language."""

    def __init__(self, langs: list[str], counts: dict[str, tuple[float, ...]]):
        self.langs, self.counts, self.memo, self.questions = langs, counts, {}, {}
        total = [sum(c[i] for c in counts.values()) for i in range(len(langs))]
        self.norm = [t + 0.5 * (len(counts) + 1) for t in total]

    def word(self, word: str) -> list[float]:
        got = self.memo.get(word)
        if got is None:
            got = [0.0] * len(self.langs)
            for g in grams(word):
                if c := self.counts.get(g):
                    for i, n in enumerate(c):
                        got[i] += math.log((n + 0.5) / self.norm[i])
            if len(self.memo) < 200_000:
                self.memo[word] = got
        return got

    def scores(self, text: str) -> dict[str, float]:
        """Log-likelihood by language, empty for a text without language."""
        words = language_words(text)
        if not words or not self.langs:
            return {}
        n_han = sum(1 for w in words if _HAN.match(w))
        if n_han and "zh" in self.langs and n_han >= 0.3 * len(words):
            return {lang: 0.0 if lang == "zh" else -50.0 for lang in self.langs}
        total = [0.0] * len(self.langs)
        for w in words:
            for i, s in enumerate(self.word(w)):
                total[i] += s
        if max(total) == min(total) == 0.0:
            return {}
        if "zh" in self.langs and not n_han:
            total[self.langs.index("zh")] = min(total) - 50.0
        return dict(zip(self.langs, total))

    def other(self, question: str, answer: str) -> bool:
        if question not in self.questions:
            q = self.scores(question)
            if len(self.questions) >= 20_000:
                self.questions.clear()
            self.questions[question] = {max(q, key=q.get), *requested(question)} if q else set()
        allowed = self.questions[question]
        a = self.scores(answer) if allowed else {}
        if not a:
            return False
        best = max(a, key=a.get)
        if best in allowed or a[best] - max(a.get(x, -1e9) for x in allowed) <= LANGUAGE_MARGIN:
            return False
        words = language_words(answer)
        if len(words) > 1 or _HAN.match(words[0]):
            return True
        # letters of one word say little: the word itself must be known as foreign
        count = self.counts.get(f"={words[0]}")
        rate = {x: (count[i] + 0.5) / self.norm[i] for i, x in enumerate(self.langs)} if count else {}
        return bool(rate) and rate[best] > 50 * max(rate.get(x, 0.0) for x in allowed)


def sentences(text: str) -> list[tuple[list[str], bool]]:
    """(words, closed) of each sentence of a plain text, numbers as ``0``."""
    out, words = [], []
    for m in _TOKEN.finditer(text):
        t = m.group()
        if t[0] in ".!?。\n":
            after = text[m.end() : m.end() + 1]
            if t[0] == "." and not (after == "" or after.isspace() or after in "\"'”’“)»*_`<"):
                continue
            if words:
                out.append((words, t[0] != "\n"))
            words = []
        else:
            words.append("0" if t.isdigit() else t)
    if words:
        out.append((words, False))
    return out


def _key(words: list[str]) -> int:
    return xxhash.xxh64_intdigest("\x1f".join(words)) - (1 << 63)


def _prefix_key(word: str, before: str = "") -> int:
    return xxhash.xxh64_intdigest(f"\x1e{before}\x1e{word}") - (1 << 63)


def breaks_off(text: str) -> bool | None:
    """In plain form: True for an open structure, False for a closed text, None where the end likelihood decides."""
    t = text.rstrip()
    bare = _QUOTED.sub(" ", t)
    if t.count("```") % 2 or any(bare.count(o) > bare.count(c) for o, c in ("{}", "[]", "()")) or t.count('"') % 2:
        return True
    if _OPEN_END.search(t) and len(textforms.words(t)) > 1:
        return True
    if _CLOSED.search(t) or (t and t[-1] in "\"”“»)]}`>』」"):
        return False
    return True if _LEADS.search(t) and len(textforms.words(t)) > 1 else None


def end_keys(text: str, stored: str) -> list[tuple[int, int]]:
    """(length, key) of the contexts at the end of a plain text; 0 and -1 are the last word as a beginning of others.

    A bare phrase (short, no capital first) may end where sentences don't; only its last word is looked up.
    """
    last = sentences(text)
    if not last:
        return []
    words = last[-1][0]
    han = bool(_HAN.search(words[-1]))
    if len(words) < (4 if han else 3) and len(last) == 1:
        return []
    first = next((ch for ch in stored if ch.isalnum()), "")
    phrase = len(last) == 1 and (len(words) <= 16 if han else len(words) <= _PHRASE and not (first.isupper() and any(ch.islower() for ch in stored)))
    if phrase and (han or "0" in words[-2:]):
        return []
    contexts = range(1, min(CONTEXT, len(words)) + 1)
    out = [(k, _key(words[-k:])) for k in contexts]
    out.append((0, _prefix_key(words[-1])))
    if len(words) > 1:
        out.append((-1, _prefix_key(words[-1], words[-2])))
    return [*out, (-2, 0)] if phrase else out


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    """(field, row_id, question, answer, lang) of both tables, distinct."""
    p = spread(table(spark, sf, "predictions").select("item_index", "pred_id", "question", "prediction"))
    q = spread(table(spark, sf, "recaption_qa").select("qa_id", "question", "answer", "lang"))
    items = table(spark, sf, "bench_items").groupBy("item_index").agg(F.min("lang").alias("lang"))
    p = p.join(F.broadcast(items), "item_index", "left").select(
        F.lit("prediction").alias("field"), F.col("pred_id").alias("row_id"), "question", F.col("prediction").alias("answer"), "lang"
    )
    q = q.select(F.lit("answer").alias("field"), F.col("qa_id").alias("row_id"), "question", "answer", "lang")
    return p.unionByName(q)


def _texts(batches):
    """(text, lang, learn): the texts of a batch once each; ``learn`` says whether the language label holds for the text,
    which it doesn't for the answer to a question that asks for a language."""
    for pdf in batches:
        found: dict[tuple, bool] = {}
        for question, answer, lang in zip(pdf.question, pdf.answer, pdf.lang):
            lang = language_code(lang)
            asked = True
            if isinstance(question, str):
                asked = bool(requested(question.casefold()))
                found[question, lang] = True
            if isinstance(answer, str):
                found[answer, lang] = found.get((answer, lang), False) or not asked
        yield pd.DataFrame([(t, lang, learn) for (t, lang), learn in found.items()], columns=["text", "lang", "learn"])


def _counts(batches):
    """One task's (kind, key, gram, n, ends): language features by language, contexts, beginnings of words."""
    words_by: dict[str, Counter] = {}
    total, ends, vocabulary = Counter(), Counter(), Counter()
    for pdf in batches:
        for stored, lang, learn in zip(pdf.text, pdf.lang, pdf.learn):
            text = plain(stored)
            if learn and isinstance(lang, str):
                words_by.setdefault(lang, Counter()).update(language_words(text))
            for words, closed in sentences(text):
                n = len(words) if closed else len(words) - 1
                vocabulary.update(zip(["", *words], words[:n]))
                for k in range(1, CONTEXT + 1):
                    total.update(zip(*[words[i : n - k + 1 + i] for i in range(k)]))
                if closed:
                    ends.update(tuple(words[-k:]) for k in range(1, min(CONTEXT, n) + 1))
    rows = []
    for lang, words in words_by.items():
        found = Counter()
        for w, n in words.items():
            for g in grams(w):
                found[g] += n
        rows += [(lang, 0, g, n, 0) for g, n in found.items()]
    rows += [("", _key(list(c)), "", n, ends[c]) for c, n in total.items()]
    begins = Counter()
    for (before, w), n in vocabulary.items():
        for i in range(1, len(w)):
            begins["", w[:i]] += n
            if before:
                begins[before, w[:i]] += n
    rows += [("", _prefix_key(w, before), "", n, 0) for (before, w), n in begins.items()]
    for i in range(0, max(1, len(rows)), 50_000):
        yield pd.DataFrame(rows[i : i + 50_000], columns=["kind", "key", "gram", "n", "ends"])


def language_model(counted: DataFrame) -> Languages:
    """The most frequent features, at most ``MAX_GRAMS`` rows to the driver."""
    rows = (
        counted.filter("kind <> ''").groupBy("kind", "gram").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "gram", "kind").limit(MAX_GRAMS).collect()
    )
    langs = sorted({r["kind"] for r in rows})
    at = {lang: i for i, lang in enumerate(langs)}
    counts: dict[str, list[float]] = {}
    for r in rows:
        counts.setdefault(r["gram"], [0.0] * len(langs))[at[r["kind"]]] = float(r["n"])
    return Languages(langs, {g: tuple(c) for g, c in counts.items()})


def classify(question: str | None, answer: str | None, languages: Languages) -> tuple[str | None, list[tuple[int, int]]]:
    """(defect, keys of the end of the text where only its likelihood can tell)."""
    if is_empty(answer):
        return "empty", []
    q, a = _plain(question or ""), plain(answer)
    if copies(q, a):
        return "copies_question", []
    if refuses(a):
        return "refusal", []
    if languages.other(q, a):
        return "other_language", []
    broken = breaks_off(a)
    if broken is None:
        return None, end_keys(a, textforms.skeleton(answer))
    return ("truncated" if broken else None), []


def find_defects(pairs: DataFrame) -> DataFrame:
    """(field, row_id, defect) from ``pairs(field, row_id, question, answer, lang)``."""
    spark = pairs.sparkSession
    texts = pairs.select("question", "answer", "lang").mapInPandas(_texts, "text string, lang string, learn boolean")
    # a fixed number of partitions: the next step is heavy for each text, so few bytes must not mean few tasks
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    once = texts.repartition(parts, "text", "lang").groupBy("text", "lang").agg(F.bool_or("learn").alias("learn"))
    counted = cut(once.mapInPandas(_counts, "kind string, key bigint, gram string, n bigint, ends bigint"))
    sent = spark.sparkContext.broadcast(language_model(counted))

    def judge(batches):
        languages, memo = sent.value, {}
        for pdf in batches:
            rows = []
            for f, i, q, a in zip(pdf.field, pdf.row_id, pdf.question, pdf.answer):
                q, a = (q if isinstance(q, str) else None), (a if isinstance(a, str) else None)
                if pd.isna(i):
                    continue
                if (q, a) not in memo:
                    if len(memo) >= 20_000:
                        memo.clear()
                    memo[q, a] = classify(q, a, languages)
                defect, keys = memo[q, a]
                if defect:
                    rows.append((f, int(i), None, defect, -1, 0))
                elif keys:
                    text = _key([q or "", a])
                    rows += [(f, int(i), text, None, k, h) for k, h in keys]
            yield pd.DataFrame(rows, columns=["field", "row_id", "text", "defect", "k", "key"]).astype({"text": "Int64"})

    judged = cut(
        pairs.select("field", "row_id", "question", "answer")
        .mapInPandas(judge, "field string, row_id bigint, text bigint, defect string, k int, key bigint")
    )
    sure = judged.filter("defect IS NOT NULL").select("field", "row_id", "defect")
    contexts = counted.filter("kind = ''").groupBy("key").agg(F.sum("n").alias("n"), F.sum("ends").alias("ends"))
    asked = judged.filter("defect IS NULL").select("field", "row_id", "text", "k", "key").distinct()
    def at(k: int):
        return F.coalesce(F.max(F.when(F.col("k") == k, F.col("n"))), F.lit(0))

    seen = asked.join(contexts, "key", "left").groupBy("field", "row_id", "text").agg(
        F.max(F.when(F.col("k") == -2, True)).alias("phrase"), at(1).alias("known"), at(2).alias("together"), at(0).alias("begins"), at(-1).alias("begins_here"),
        F.max_by(F.col("ends") / F.col("n"), F.when((F.col("k") > 0) & (F.col("n") > 2), F.col("k"))).alias("share"),
    )
    within = ((F.col("known") == 0) & (F.col("begins") > 0)) | ((F.col("together") == 0) & (F.col("begins_here") > 0))
    unlikely = F.col("phrase").isNull() & (F.col("known") > 0) & (F.coalesce("share", F.lit(1.0)) < END_SHARE)
    broken = seen.filter(within | unlikely).select("field", "row_id", F.lit("truncated").alias("defect"))
    return sure.unionByName(broken).distinct()


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return find_defects(_pairs(spark, sf))


QUERIES = {"p4_found": p4_found}
ORACLES: dict[str, str] = {}
