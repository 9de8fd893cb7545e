"""Answer normalisation, extraction and scoring, as column expressions inside whole-stage code.

Every function takes columns (or their names) and returns a column; null text gives null unless
stated. Words are separated by any Unicode blank; word borders are borders of letters and digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pixloom.functions.parsing import as_col

BLANK = r"[\s\p{Z}]+"
BEFORE, AFTER = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"

# Punctuation of the public VQA normaliser, in its order.
PUNCTUATION = [";", "/", "[", "]", '"', "{", "}", "(", ")", "=", "+", "\\", "_", "-", ">", "<", "@", "`", ",", "?", "!"]
# Fixed value: the normaliser strips at most so many full stops.
MAX_STOPS = 32
ARTICLES = ["a", "an", "the"]
# Number words of the public VQA normaliser.
NUMBERS = {
    "none": "0", "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8",
    "nine": "9", "ten": "10",
}
# Contractions of the public VQA normaliser that a lower-cased word can meet and that change it.
CONTRACTIONS = {
    "aint": "ain't", "arent": "aren't", "cant": "can't", "couldve": "could've", "couldnt": "couldn't", "couldn'tve": "couldn't've",
    "couldnt've": "couldn't've", "didnt": "didn't", "doesnt": "doesn't", "dont": "don't", "hadnt": "hadn't", "hadnt've": "hadn't've",
    "hadn'tve": "hadn't've", "hasnt": "hasn't", "havent": "haven't", "hed": "he'd", "hed've": "he'd've", "he'dve": "he'd've", "hes": "he's",
    "howd": "how'd", "howll": "how'll", "hows": "how's", "isnt": "isn't", "itd": "it'd", "itd've": "it'd've", "it'dve": "it'd've",
    "itll": "it'll", "maam": "ma'am", "mightnt": "mightn't", "mightnt've": "mightn't've", "mightn'tve": "mightn't've", "mightve": "might've",
    "mustnt": "mustn't", "mustve": "must've", "neednt": "needn't", "notve": "not've", "oclock": "o'clock", "oughtnt": "oughtn't",
    "ow's'at": "'ow's'at", "'ows'at": "'ow's'at", "'ow'sat": "'ow's'at", "shant": "shan't", "shed've": "she'd've", "she'dve": "she'd've",
    "shouldve": "should've", "shouldnt": "shouldn't", "shouldnt've": "shouldn't've", "shouldn'tve": "shouldn't've", "somebody'd": "somebodyd",
    "somebodyd've": "somebody'd've", "somebody'dve": "somebody'd've", "somebodyll": "somebody'll", "somebodys": "somebody's",
    "someoned": "someone'd", "someoned've": "someone'd've", "someone'dve": "someone'd've", "someonell": "someone'll", "someones": "someone's",
    "somethingd": "something'd", "somethingd've": "something'd've", "something'dve": "something'd've", "somethingll": "something'll",
    "thats": "that's", "thered": "there'd", "thered've": "there'd've", "there'dve": "there'd've", "therere": "there're", "theres": "there's",
    "theyd": "they'd", "theyd've": "they'd've", "they'dve": "they'd've", "theyll": "they'll", "theyre": "they're", "theyve": "they've",
    "twas": "'twas", "wasnt": "wasn't", "wed've": "we'd've", "we'dve": "we'd've", "weve": "we've", "werent": "weren't", "whatll": "what'll",
    "whatre": "what're", "whats": "what's", "whatve": "what've", "whens": "when's", "whered": "where'd", "wheres": "where's",
    "whereve": "where've", "whod": "who'd", "whod've": "who'd've", "who'dve": "who'd've", "wholl": "who'll", "whos": "who's", "whove": "who've",
    "whyll": "why'll", "whyre": "why're", "whys": "why's", "wont": "won't", "wouldve": "would've", "wouldnt": "wouldn't",
    "wouldnt've": "wouldn't've", "wouldn'tve": "wouldn't've", "yall": "y'all", "yall'll": "y'all'll", "y'allll": "y'all'll",
    "yall'd've": "y'all'd've", "y'alld've": "y'all'd've", "y'all'dve": "y'all'd've", "youd": "you'd", "youd've": "you'd've",
    "you'dve": "you'd've", "youll": "you'll", "youre": "you're", "youve": "you've",
}
# Texts of failed and refused answers.
FAILED = "Failed to obtain answer via API"
REFUSED = [
    "Sorry, I can't help with images of people yet.", "I can't process this file.", "I'm sorry, but without the image provided",
    "Cannot determine the answer",
]
# Prefixes removed before a letter is looked for; two of them are each two joined prefixes.
PREFIXES = [
    "The best answer is", "The correct answer is", "The answer is", "The answer", "The best option isThe correct option is",
    "Best answer:Best option:",
]
# Number words from zero.
COUNT_WORDS = [
    "zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen", "fourteen",
    "fifteen", "sixteen", "seventeen", "eighteen", "nineteen", "twenty",
]


def words(c: Column | str) -> Column:
    """Blank-separated words, no empty ones."""
    return F.filter(F.split(as_col(c), BLANK), lambda w: w != "")


def strip(c: Column | str) -> Column:
    return F.regexp_replace(as_col(c), r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def no_punctuation(c: Column | str) -> Column:
    """A mark beside a blank, or any mark where a number has a thousands comma, is deleted; others become blanks.
    Then at most 32 full stops that stand beside no digit are deleted."""


    def clean(x: Column) -> Column:
        t, comma = x["t"], x["comma"]
        out = t
        for p in PUNCTUATION:
            beside = F.contains(t, F.lit(f"{p} ")) | F.contains(t, F.lit(f" {p}")) | comma
            out = F.replace(out, F.lit(p), F.when(beside, "").otherwise(" "))
        return F.array_join(F.split(out, r"(?<!\p{Nd})\.(?!\p{Nd})", MAX_STOPS + 1), "")

    # the text is named once, so what computes it runs once and not for every mark
    whole = F.transform(F.array(as_col(c)), lambda t: F.struct(t.alias("t"), t.rlike(r"\p{Nd},\p{Nd}").alias("comma")))
    return F.transform(whole, clean)[0]


def no_articles(c: Column | str) -> Column:
    """Lower case; number words as digits, articles dropped, contractions restored."""
    to = {**CONTRACTIONS, **NUMBERS}
    table = F.map_from_arrays(F.array(*[F.lit(k) for k in to]), F.array(*[F.lit(v) for v in to.values()]))
    kept = F.filter(words(F.lower(as_col(c))), lambda w: ~w.isin(*ARTICLES))
    return F.array_join(F.transform(kept, lambda w: F.coalesce(F.element_at(table, w), w)), " ")


def normal_answer(c: Column | str) -> Column:
    """The whole normaliser: line ends as blanks, stripped, no punctuation, no articles."""
    return no_articles(no_punctuation(strip(F.translate(as_col(c), "\n\t", "  "))))


def vqa_soft(pred: Column | str, truths: Column | str) -> Column:
    """Mean over the given answers of min(1, number of the others equal to the prediction / 3)."""
    p, gts = as_col(pred), as_col(truths)
    same = F.size(F.filter(gts, lambda g: g == p))
    score = F.transform(gts, lambda g: F.least(F.lit(1.0), (same - (g == p).cast("int")) / 3))
    return F.when(F.size(gts) > 0, F.aggregate(score, F.lit(0.0), lambda a, x: a + x) / F.size(gts))


def collapsed(c: Column | str) -> Column:
    return F.array_join(words(F.lower(as_col(c))), " ")


def anls_distance(truth: Column | str, pred: Column | str) -> Column:
    """Edit distance of the lower-cased, blank-collapsed texts over the greater raw length."""
    t, p = as_col(truth), as_col(pred)
    n = F.greatest(F.length(t), F.length(p))
    return F.when(n == 0, F.lit(0.0)).otherwise(F.levenshtein(collapsed(t), collapsed(p)) / n)


def anls(truth: Column | str, pred: Column | str, threshold: float = 0.5) -> Column:
    s = 1 - anls_distance(truth, pred)
    return F.when(s < threshold, F.lit(0.0)).otherwise(s)


def number(c: Column | str) -> Column:
    """A float, ``%`` as a hundredth; null for other texts."""
    t = strip(c)
    plain = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
    body = F.regexp_replace(t, "%+$", "")
    value = F.when(body.rlike(plain), body.try_cast("double"))
    return F.when(t.endswith("%"), value / 100).otherwise(value)


def relaxed(pred: Column | str, truth: Column | str, tolerance: float = 0.05, denominator: str = "prediction") -> Column:
    """Within ``tolerance`` of the prediction (or, with ``denominator="target"``, of the truth), else equal but for case.

    A denominator of 0 compares the texts."""
    p, t = strip(pred), as_col(truth)
    a, b = number(p), number(t)
    low = a if denominator == "prediction" else b
    close = F.abs(a - b) / F.abs(low) <= tolerance
    return F.when(a.isNotNull() & b.isNotNull() & (low != 0), close).otherwise(F.lower(p) == F.lower(t))


def exact(pred: Column | str, truth: Column | str) -> Column:
    return F.lower(strip(pred)) == F.lower(strip(truth))


def infer_option(text: Column | str, letters: Column) -> Column:
    """The only option letter that stands as a word; Z for refusals; null when undecided or failed."""
    t = as_col(text)
    w = words(F.translate(t, ".()[],:;!*#{}", " " * 13))
    found = F.array_intersect(letters, w)
    refused = F.lit(False)
    for r in REFUSED:
        refused = refused | F.contains(t, F.lit(r))
    none_but_z = (F.size(found) == 0) & F.array_contains(w, "Z")
    return F.when(F.contains(t, F.lit(FAILED)), F.lit(None)).when(refused | none_but_z, "Z").when(F.size(found) == 1, found[0])


def infer_text(text: Column | str, options: Column) -> Column:
    """The letter of the only option (map of letter to text) whose text is contained; null otherwise."""
    t = F.lower(as_col(text))
    found = F.map_keys(F.map_filter(options, lambda _, v: F.contains(t, F.lower(v))))
    return F.when(F.size(found) == 1, found[0])


def infer_sequence(text: Column | str) -> Column:
    """An order of four letters: written together, by ordinals, or by numbered steps; null otherwise."""
    t = F.upper(as_col(text))
    together = F.regexp_extract(t, BEFORE + "([A-D]{4})" + AFTER, 1)
    ordinals = ["first|1st|首先|第一步", "second|2nd|其次|第二步", "third|3rd|再次|第三步", "fourth|4th|最后|第四步"]
    found = F.array_distinct(F.array(*[F.regexp_extract(t, f"(?i)(?:{o}).*?([A-D])", 1) for o in ordinals]))
    steps = F.slice(F.regexp_extract_all(t, F.lit(r"(?i)(?:step\s*[\d一二三四]+|步骤\s*[\d一二三四]+|第\s*[\d一二三四]\s*步).*?([A-D])"), F.lit(1)), 1, 4)
    full = lambda a: (F.size(F.array_distinct(a)) == 4) & ~F.array_contains(a, "")
    spread = F.split(together, "")
    return (
        F.when((together != "") & (F.size(F.array_distinct(F.filter(spread, lambda x: x != ""))) == 4), together)
        .when(full(found), F.array_join(found, ""))
        .when(full(steps), F.array_join(steps, ""))
    )


def yes_no(text: Column | str) -> Column:
    """Yes or No when exactly one of the words stands in the normalised text, else Unknown."""
    w = words(no_punctuation(F.lower(as_col(text))))
    yes, no = F.array_contains(w, "yes"), F.array_contains(w, "no")
    return F.when(yes & ~no, "Yes").when(no & ~yes, "No").otherwise("Unknown")


def first_letter(text: Column | str) -> Column:
    """First of A to E after known prefixes are removed; a fragment of ``(A)`` counts; empty when there is none."""
    s = strip(text)
    for p in PREFIXES:
        s = F.replace(s, F.lit(p), F.lit(""))
    letter = F.regexp_extract(s, "[ABCDE]", 0)
    part = F.filter(F.array(*[F.lit(f"({x})") for x in "abcde"]), lambda o: F.contains(o, F.lower(s)))
    return (
        F.when(letter != "", letter).when(F.size(words(s)) > 10, "")
        .when(F.size(part) > 0, F.upper(F.substring(part[0], 2, 1))).otherwise("")
    )


def first_of_two(text: Column | str, one: str, other: str) -> Column:
    """1 if the word ``one`` stands first, 0 if ``other`` does, -1 if neither occurs."""
    a = F.regexp_instr(as_col(text), F.lit(f"(?i){BEFORE}{one}{AFTER}"))
    b = F.regexp_instr(as_col(text), F.lit(f"(?i){BEFORE}{other}{AFTER}"))
    return F.when((a == 0) & (b == 0), -1).when(b == 0, 1).when(a == 0, 0).when(a < b, 1).otherwise(0)


def small_count(text: Column | str) -> Column:
    """First whole number from 0 to 20, in digits or in words; null when there is none."""
    t = F.lower(as_col(text))
    found = F.regexp_extract(t, BEFORE + "(" + "|".join(["[0-9]", "1[0-9]", "20", *COUNT_WORDS]) + ")" + AFTER, 1)
    at = F.array_position(F.array(*[F.lit(w) for w in COUNT_WORDS]), found)
    return F.when(found.rlike("^[0-9]+$"), found.try_cast("int")).when(at > 0, (at - 1).cast("int"))


def all_numbers(text: Column | str) -> Column:
    """All runs of digits, as integers."""
    return F.filter(F.transform(F.regexp_extract_all(as_col(text), F.lit(r"([0-9]+)"), F.lit(1)), lambda x: x.try_cast("bigint")), lambda x: x.isNotNull())


def counting_score(gt: Column, numbers: Column, length: Column, penalty: float = 10.0, l_max: int = 4) -> Column:
    """100 for the right count, less by a root of the relative error, 0 unless exactly one number was given."""
    n = F.coalesce(length, F.lit(2))
    far = F.greatest(gt - 1, n - gt, F.lit(1))
    loss = (F.lit(float(l_max)) / n) * F.pow(F.abs(numbers[0] - gt) / far, F.lit(1.0 / penalty))
    return F.when(F.size(numbers) != 1, 0.0).when(numbers[0] == gt, 100.0).otherwise(F.greatest(F.lit(0.0), 100 * (1 - loss)))


def bag_prf(pred: Column, truth: Column) -> Column:
    """Precision, recall and F1 by list membership (not multisets) of two word lists; 0 where undefined."""
    hit_p = F.size(F.filter(pred, lambda w: F.array_contains(truth, w)))
    hit_t = F.size(F.filter(truth, lambda w: F.array_contains(pred, w)))
    p = F.when(F.size(pred) > 0, hit_p / F.size(pred)).otherwise(0.0)
    r = F.when(F.size(truth) > 0, hit_t / F.size(truth)).otherwise(0.0)
    return F.struct(p.alias("p"), r.alias("r"), F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0).alias("f1"))


def centimetres(value: Column, unit: Column) -> Column:
    """Metric and imperial lengths in centimetres, 0 for an unknown unit."""
    u = F.lower(unit)
    scale = F.when(u.isin("m", "meter", "meters"), 100.0).when(u.isin("cm", "centimeter", "centimeters"), 1.0)
    scale = scale.when(u.isin("ft", "foot", "feet"), 30.48).when(u.isin("in", "inch", "inches"), 2.54).when(u.isin("mm", "millimeter"), 0.1).otherwise(0.0)
    return value * scale


def within_factor(pred: Column, truth: Column, factor: float) -> Column:
    """Both sides plus 1e-8; true when the greater quotient stays below ``factor``."""
    p, t = F.coalesce(pred, F.lit(0.0)) + 1e-8, F.coalesce(truth, F.lit(0.0)) + 1e-8
    return F.greatest(p / t, t / p) < factor
