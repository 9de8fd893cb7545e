"""Subject areas of texts (problem 9): multi-label, over the closed list of ``subjects``.

One-versus-rest linear classifiers over hashed word n-grams score every sentence of every text. Their
weights are log-odds from one counting pass with weak labels: seed words (``SEEDS``), ratings, and the
subject that all seeds of a text agree on, which its other sentences inherit. Sentences about nothing
occur with all subjects, so their log-odds vanish. A sentence treats the subject that passes its
threshold and leads by ``LEAST_LEAD``; where none does, the seed words decide; comparisons ("reminds one of") and
names with a number treat none. A text has the subject most of
its sentences treat and each further one treated by ``SECOND`` of them. The threshold of a subject is
calibrated on all rated documents: of ``THRESHOLDS`` the one of best F1, the nearest to
``LEAST_SCORE`` of equals.

Plan. Labelled sentences are made distinct by one shuffle, so counts don't depend on how rows fall into tasks; counting
is combined inside each task, so the next shuffle carries vocabularies. All features keep their weights, in a table.
One pass splits the texts; each different sentence is scored once, by a join of its features with the weights, and its result
joined to the texts that hold it. The driver gets one row of totals and the tallies of each subject and threshold.

Defined results: null, empty and blank texts have no row; repeated rows count once; the language column
is not read; subjects without seed words are learnt from ratings alone.
"""

from __future__ import annotations

import functools
import math
from collections import Counter

import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixloom.llm import textforms
from pixloom.session import cut, spread, table

#: Sentences that make a subject beside the first one count.
SECOND = 3
#: Least log-odds of a subject in a sentence and least lead over the next subject.
LEAST_SCORE, LEAST_LEAD = 4.0, 2.0
THRESHOLDS = (2.5, 3.0, 3.5, 4.0, 4.5, 5.0, 6.0)
#: Log-odds are whole numbers of 1 / UNIT, so that sums don't depend on their order.
UNIT = 1_000_000

#: Beginnings of words (Latin script) and strings (Chinese) that tell a subject: the weak labels.
SEEDS = {
    "wildlife": "heron lynx otter kingfisher owl bison python_on fox_cub puffin boar hawk plumage burrow breeding nest field_mouse sea_turtle moth graureiher luchs eisvogel schleiereule bisonherde habicht garza lince nutria búho lechuza bisonte halcón martín 白鹭 猞猁 水獭 翠鸟 猫头鹰 野牛 蟒蛇 幼崽 觅食",
    "food": "stew soup dumpling pancake biscuit jam mushroom goat_cheese rye_bread radish syrup custard dough recipe oven leek pflaumenmus graupensuppe mandelkekse pfanne roggenbrot eintopf teigtaschen butter sopa galletas mermelada setas pan_de_centeno lentejas horno 饺子 大麦汤 果酱 杏仁饼 腌萝卜 黑麦面包 扁豆 烤炉 芝麻",
    "sport": "goalkeeper referee fencer tennis gymnast jumper rower rowing judo pitcher batter climber relay scoreboard stopwatch medal offside torwart tennisspielerin ruderachter staffelläuferin fechter schiedsrichter portero árbitro esgrimista tenista corredora equipo_de_remo 守门员 裁判 网球 击剑 接力 赛艇 攀岩 发令枪",
    "architecture": "chapel library vaulted staircase facade terraced barn pavilion courtyard arcade roof_garden stairwell cornice architect floor_plan kapelle fachwerk wasserturm treppenhaus bibliothek_aus gerüst wendeltreppe capilla escalera_de_caracol biblioteca_de torre_de_agua andamio fachada 礼拜堂 图书馆 楼梯 联排 水塔 谷仓 脚手架",
    "medicine": "nurse patient stethoscope vaccine infusion surgical biopsy dosage radiograph blood x-ray knee_scan incubators symptoms dentist pulse pflegerin röntgen infusionspumpe klemmen blutausstrich dienstarzt enfermera radiografía infusión pinzas_quir frotis médico 护士 输液泵 手术 血涂片 疫苗 膝关节 胸部 医生",
    "software": "login code_editor stack_trace dropdown merge_request database python_script breakpoint tooltip widget debug dashboard crash_report settings_dialog unit_tests commit_message package_manager anmeldeformular code-editor terminalfenster einstellungsdialog build testserver acceso editor_de_código ventana_de_terminal ajustes fallos servidor 代码 登录 终端 数据库 崩溃 仪表盘 调试",
    "transport": "tram locomotive seaplane barge ferry taxi train bus van cable_car freight container_ship toll_booth scooter timetable pantograph dampflok frachtkahn nachtzug lieferwagen straßenbahn bahnhof tranvía locomotora barcaza furgoneta estación 电车 机车 驳船 火车 面包车 双层巴士 集装箱 车站",
    "fashion": "skirt coat scarf jacket boots handbag vest gown batik raincoat straw_hat belt mannequin lining sleeves stitching leinenrock mantel seidentuch wildlederstiefel strickweste saum falda abrigo pañuelo chaleco botines dobladillo 裙 大衣 丝巾 短靴 背心 草帽 外套 下摆",
    "fine_art": "watercolour fresco altarpiece woodcut torso self-portrait still_life tapestry oil_study varnish canvas pigment bronze relief gilded scroll collage glazes aquarell ölstudie selbstporträt holzschnitt marmortorso pinsel acuarela grabado torso autorretrato óleo pinceladas 水彩 木刻 油画 自画像 躯干像 铜像 笔触 长卷",
    "science": "telescope fossil crystal pendulum beaker spectrum microscope volcano circuit molar isotope decay nebula petri hypothesis error_bars logarithmic kristallgitter pendelversuch spektrum elektronenmikroskop wasserkreislauf hypothese espectro péndulo microscopio ciclo_del_agua red_cristalina hipótesis 晶格 单摆 光谱 显微镜 星云 水循环 火山 假设",
    "law": "witness court judge notary lease plaintiff verdict clause statute summons power_of_attorney case_files jurisdiction penalty patent zeugenaussage gericht notar mietvertrag akten vollmacht testigo judicial notarial contrato expedientes sentencia 证词 法院 公证 合同 案卷 授权委托 传票 书记员",
    "finance": "invoice receipt balance_sheet bank bond stock_ticker candlestick payroll dividend tax_form exchange_rates inflation pie_chart margin loan deposit revenue savings kontoauszug rechnung kerzendiagramm kreisdiagramm bilanz verlust extracto factura gráfico balance partidas pérdidas 资产负债 发票 支出饼图 对账单 汇率 K线 季度 外币",
}
_COMPARISON = regex.compile(
    r"\b(?:reminds?|reminiscent|mistaken|resembles?|looks? (?:a bit |almost )?like|as if it were|compared to|erinner\w*|verwechsel\w*|ähnel\w*|sieht aus wie|recuerda\w*|confund\w*|parece\w*)\b|让人想起|像是|看似|误认|好似|令人联想|仿佛"
)
_MARKUP = regex.compile(r"<\|?[^<>]*\|?>|&\w+;|^\s*(?:q|a)\s*:\s*", regex.M | regex.I)
_BOUNDS = regex.compile(r"[.!?。！？]+(?=[\s\"”’)]|$|\p{Han})|[。！？\n\r]+|<\|[^<>]*\|>")
_HAN = regex.compile(r"\p{Han}")
_NUMBER = regex.compile(r"\p{N}+")
#: A word and a number: the name of a file, not a text (numbers as 0).
_NAME = regex.compile(r"\W*[^\W\d]*[\W_]*0(?:\W*\p{L}{3,4})?\W*$")


def sentences(text: str) -> list[str]:
    """In canonical characters and lower case."""
    text = textforms.skeleton(text.replace("\r", "\n").replace("\n", " 。 ")).casefold()
    parts = _BOUNDS.split(text)
    return [s for s in (_MARKUP.sub(" ", p).strip() for p in parts) if s]


def no_numbers(sentence: str) -> str:
    """Numbers as 0: they tell no subject, and so sentences repeat."""
    return _NUMBER.sub("0", sentence)


@functools.lru_cache(maxsize=100_000)
def features(sentence: str) -> list[int]:
    """Hashes of words and word pairs; of two to four characters in Chinese."""
    words = [w for w in textforms._ANY_WORDS(sentence) if not w.isdigit()]
    names, run = [], []
    for w in words:
        if _HAN.match(w):
            run.append(w)
            continue
        names.append(w)
    names += [f"{a} {b}" for a, b in zip(names, names[1:])]
    names += ["".join(run[i : i + n]) for n in (2, 3, 4) for i in range(len(run) - n + 1)]
    return [xxhash.xxh64_intdigest(x) - (1 << 63) for x in dict.fromkeys(names)]


@functools.cache
def _machine():
    """One automaton of all seeds; each end gives the (subject, length, Chinese) of the seeds that are the same string."""
    import ahocorasick

    by: dict[str, list] = {}
    for subject, seeds in SEEDS.items():
        for s in seeds.split():
            han = bool(_HAN.search(s))
            s = s.casefold() if han else s.replace("_", " ")
            by.setdefault(s, []).append((subject, len(s), han))
    machine = ahocorasick.Automaton()
    for s, what in by.items():
        machine.add_word(s, what)
    machine.make_automaton()
    return machine


def _word(ch: str) -> bool:
    return ch.isalnum() or ch == "_"


@functools.lru_cache(maxsize=100_000)
def seed_label(sentence: str) -> str | None:
    """The only subject whose seeds the sentence holds.

    A seed in letters stands at the beginning of a word; the word may go on by two letters, or by any after six of the seed."""
    found = set()
    for end, seeds in _machine().iter(sentence):
        after = sentence[end + 1 : end + 4]
        for subject, n, han in seeds:
            if subject in found:
                continue
            if not han:
                begin = end - n + 1
                if begin and _word(sentence[begin - 1]):
                    continue
                short = next((k for k in range(3) if k >= len(after) or not _word(after[k])), 3)
                if not (short < 3 and after[:short].isalpha() or short == 0 or n >= 6 and all(map(_word, sentence[end - 5 : end + 1]))):
                    continue
            found.add(subject)
    return found.pop() if len(found) == 1 else None


def log_odds(counts: list[float], total: list[float], size: float) -> list[int] | None:
    """Weights of a feature by subject, from its counts and those of all features; None if it tells no subject."""
    n_all, every, w = sum(counts), sum(total), []
    for n, t in zip(counts, total):
        here, rest = (n + 0.5) / (t + 0.5 * size), (n_all - n + 0.5) / (every - t + 0.5 * size)
        w.append(round(UNIT * max(-3.0, min(3.0, math.log(here / rest)))))
    return w if max(w) > UNIT else None


def _says_nothing(sentence: str) -> bool:
    return bool(_COMPARISON.search(sentence) or _NAME.match(sentence))


class Subjects:
    """The whole model on one machine. ``weights``: feature to its log-odds by subject."""

    def __init__(self, names: list[str], counts: dict[int, dict[str, float]]):
        self.names = names
        by_name = {f: [by.get(s, 0.0) for s in names] for f, by in counts.items()}
        total = [sum(n) for n in zip(*by_name.values())] or [0.0] * len(names)
        self.weights = {f: log_odds(n, total, len(counts) + 1.0) for f, n in by_name.items()}
        self.memo: dict[str, tuple] = {}
        self.thresholds = dict.fromkeys(names, LEAST_SCORE)

    def scored(self, sentence: str) -> tuple[str | None, float, str | None]:
        """(subject that leads, its score, subject by seed words where the score falls short)."""
        found = self.memo.get(sentence)
        if found is None:
            found = (None, 0.0, None)
            if not _says_nothing(sentence):
                score, own = [0] * len(self.names), features(sentence)
                for f in own:
                    if w := self.weights.get(f):
                        for i, x in enumerate(w):
                            score[i] += x
                order = sorted(range(len(score)), key=lambda i: -score[i])
                leads = bool(order) and (len(order) < 2 or score[order[0]] - score[order[1]] >= LEAST_LEAD * UNIT)
                seed = seed_label(sentence)
                found = (self.names[order[0]] if leads else None, score[order[0]] / UNIT if leads else 0.0, seed if seed in self.names else None)
            if len(self.memo) < 100_000:
                self.memo[sentence] = found
        return found

    def sentence(self, sentence: str) -> str | None:
        subject, score, seed = self.scored(sentence)
        return subject if subject and score >= self.thresholds[subject] else seed

    def text(self, text: str | None) -> list[str]:
        return [] if not text or not text.strip() else _decide(Counter(s for s in map(self.sentence, map(no_numbers, sentences(text))) if s))

    def calibrate(self, rated: list[tuple[str, str]]) -> None:
        """Set the thresholds from (text, subject) of rated documents."""
        seen = [(subject, [(*self.scored(no_numbers(s)), 1) for s in sentences(text)]) for text, subject in rated if text and text.strip()]
        tallies = Counter(x for subject, parts in seen for x in _trials(self.names, subject, parts))
        self.thresholds = _best(self.names, tallies, Counter(subject for subject, _ in seen))


def _treated(parts: list[tuple], at: dict[str, float]) -> list[str]:
    """Subjects of a text from (subject that leads, score, subject by seed words, times) of its sentences."""
    n = Counter()
    for lead, score, seed, times in parts:
        if s := lead if lead and score >= at[lead] else seed:
            n[s] += times
    return _decide(n)


def _trials(names: list[str], subject: str, parts: list[tuple]):
    """(name, threshold, right) wherever a text rated ``subject`` gets a name with this threshold, the others at ``LEAST_SCORE``."""
    at = dict.fromkeys(names, LEAST_SCORE)
    for name in names:
        if subject == name or any(p[0] == name for p in parts):
            for t in THRESHOLDS:
                if name in _treated(parts, {**at, name: t}):
                    yield name, t, subject == name


def _best(names: list[str], tallies: dict[tuple, int], rated: dict[str, int]) -> dict[str, float]:
    """Of each subject the threshold of best F1; ``rated``: texts rated with it."""
    chosen = {}
    for name in names:
        best = None
        for t in sorted(THRESHOLDS, key=lambda t: abs(t - LEAST_SCORE)):
            hit, wrong = tallies.get((name, t, True), 0), tallies.get((name, t, False), 0)
            f1 = 2 * hit / (hit + wrong + rated.get(name, 0)) if hit else 0.0
            if best is None or f1 > best[0]:
                best = (f1, t)
        chosen[name] = best[1]
    return chosen


def _decide(n: Counter) -> list[str]:
    """Subjects of a text from the number of sentences that treat each."""
    if not n:
        return []
    first = max(n, key=lambda s: (n[s], s))
    return [s for s in n if s == first or n[s] >= SECOND]


def _rated(labels: DataFrame) -> DataFrame:
    """(doc_id, rated): the subject of documents on which all raters agree."""
    return labels.groupBy("doc_id").agg(F.collect_set("subject").alias("r")).filter("size(r) = 1").selectExpr("doc_id", "r[0] AS rated")


def _labelled(batches):
    """(subject, sentence) of the weakly labelled sentences of each batch, once each."""
    for pdf in batches:
        found = {}
        for text, rated in zip(pdf.text, pdf.rated):
            if not isinstance(text, str):
                continue
            parts = [s for s in sentences(text) if not _COMPARISON.search(s)]
            labels = [seed_label(no_numbers(s)) for s in parts]
            known = Counter(x for x in labels if x)
            # a document whose seeds agree (or, without seeds, its rating) names its other sentences
            whole = next(iter(known)) if len(known) == 1 else None
            if not known and isinstance(rated, str):
                whole = rated
            found.update(((label or whole, s), None) for s, label in zip(parts, labels) if label or whole)
        yield pd.DataFrame(list(found), columns=["subject", "sentence"])


def _counts(batches):
    """One task's (subject, feature, n) over distinct labelled sentences."""
    found = Counter()
    for pdf in batches:
        for subject, sentence in zip(pdf.subject, pdf.sentence):
            found.update((subject, f) for f in features(no_numbers(sentence)))
    rows = [(s, f, n) for (s, f), n in found.items()]
    for i in range(0, max(1, len(rows)), 50_000):
        yield pd.DataFrame(rows[i : i + 50_000], columns=["subject", "feature", "n"])


def _digest(text: str) -> bytes:
    return xxhash.xxh3_128_digest(text.encode())


def _held(batches):
    """(doc_id, text, sentence, words, n): how often a text holds each sentence, both as digests; words only where the task first meets
    the sentence. A text without sentences has one row without."""
    met = set()
    for pdf in batches:
        rows = []
        for i, text in zip(pdf.doc_id, pdf.text):
            if not isinstance(text, str) or not text.strip():
                continue
            own = _digest(text)
            held = Counter(map(no_numbers, sentences(text)))
            for s, n in held.items():
                key = _digest(s)
                rows.append((i, own, key, None if key in met else s, n))
                if len(met) < 500_000:
                    met.add(key)
            if not held:
                rows.append((i, own, None, None, 0))
        yield pd.DataFrame(rows, columns=["doc_id", "text", "sentence", "words", "n"])


def _parts(spark: SparkSession) -> int:
    """A fixed number of partitions: what follows is heavy for each sentence, so few bytes must not mean few tasks."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def train(documents: DataFrame, labels: DataFrame, names: list[str]) -> DataFrame:
    """(feature, w0, w1, ...): the weights of all features that tell a subject, in the order of ``names``."""
    of_name = [F.coalesce(F.sum(F.when(F.col("subject") == s, F.col("n"))), F.lit(0)).alias(f"n{i}") for i, s in enumerate(names)]
    counted = cut(
        documents.select("doc_id", "text").join(_rated(labels), "doc_id", "left").select("text", "rated")
        .mapInPandas(_labelled, "subject string, sentence string").filter(F.col("subject").isin(names))
        .repartition(_parts(documents.sparkSession), "subject", "sentence").distinct()
        .mapInPandas(_counts, "subject string, feature bigint, n bigint")
        .groupBy("feature").agg(*of_name)
    )
    size, *total = counted.agg(F.count("*"), *(F.sum(f"n{i}") for i in range(len(names)))).first()
    total = [float(t or 0) for t in total]

    def weigh(batches):
        for pdf in batches:
            rows = [(f, *w) for f, *n in pdf.itertuples(index=False) if (w := log_odds(n, total, size + 1.0))]
            yield pd.DataFrame(rows, columns=["feature", *(f"w{i}" for i in range(len(names)))])

    return counted.mapInPandas(weigh, "feature bigint" + "".join(f", w{i} bigint" for i in range(len(names))))


def _scored(sentences: DataFrame, weights: DataFrame, names: list[str]) -> DataFrame:
    """(sentence, lead, level, seed) of ``sentences(sentence, words)``: numbers of subjects, -1 for none, and how many ``THRESHOLDS``
    the score passes; sentences that treat nothing at any threshold are left out."""

    def told(batches):
        at = {s: i for i, s in enumerate(names)}
        for pdf in batches:
            rows = []
            for key, s in zip(pdf.sentence, pdf.words):
                if not _says_nothing(s):
                    seed = at.get(seed_label(s), -1)
                    rows.append((key, seed, features(s) or [0]))
            yield pd.DataFrame(rows, columns=["sentence", "seed", "features"])

    own = sentences.mapInPandas(told, "sentence binary, seed int, features array<bigint>").select("sentence", "seed", F.explode("features").alias("feature"))
    total = F.array(*(F.coalesce(F.sum(f"w{i}"), F.lit(0)) for i in range(len(names))))
    best = F.array_max("total")
    leads = best - F.sort_array("total", asc=False)[1] >= int(LEAST_LEAD * UNIT) if len(names) > 1 else F.lit(True)
    level = sum((best >= int(t * UNIT)).cast("int") for t in THRESHOLDS)
    return (
        own.join(weights, "feature", "left").filter("w0 IS NOT NULL OR seed >= 0")
        .groupBy("sentence").agg(F.max("seed").alias("seed"), total.alias("total"))
        .select("sentence", F.when(leads, F.array_position("total", best) - 1).otherwise(-1).cast("int").alias("lead"), level.alias("level"), "seed")
        .filter("lead >= 0 AND level > 0 OR seed >= 0")
    )


def _thresholds(held: DataFrame, texts: DataFrame, labels: DataFrame, names: list[str]) -> dict[str, float]:
    """Calibrated on all rated documents; equal texts of equal rating count once."""
    rated = _rated(labels).filter(F.col("rated").isin(names))

    def tally(batches):
        for pdf in batches:
            found = Counter(x for row in pdf.itertuples(index=False) for x in _trials(names, row.rated, _unpacked(row, names)))
            yield pd.DataFrame([(*k, n) for k, n in found.items()], columns=["name", "t", "right", "n"])

    tried = texts.join(rated, "doc_id").dropDuplicates(["text", "rated"]).mapInPandas(tally, "name string, t double, right boolean, n bigint")
    tallies = {(r["name"], r["t"], r["right"]): r["n"] for r in tried.groupBy("name", "t", "right").agg(F.sum("n").alias("n")).collect()}
    of = held.select("doc_id", "text").join(rated, "doc_id").select("text", "rated").distinct().groupBy("rated").count()
    return _best(names, tallies, {r["rated"]: r["count"] for r in of.collect()})


def _unpacked(row, names: list[str]) -> list[tuple]:
    """What ``_treated`` takes, from the arrays of a text; a score as the greatest threshold it passes."""
    passed = [-math.inf, *sorted(THRESHOLDS)]
    name = lambda i: names[i] if i >= 0 else None
    return [(name(i), passed[k], name(j), n) for i, k, j, n in zip(row.lead, row.level, row.seed, row.n)]


def document_subjects(documents: DataFrame, labels: DataFrame, subjects: DataFrame) -> DataFrame:
    """(doc_id, subject) of every text."""
    spark, names = documents.sparkSession, sorted(r[0] for r in subjects.select("subject").distinct().collect() if r[0])
    if not names:
        return spark.createDataFrame([], "doc_id bigint, subject string")
    held = cut(
        documents.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("bigint"), "text")
        .mapInPandas(_held, "doc_id bigint, text binary, sentence binary, words string, n int")
    )
    different = held.filter("words IS NOT NULL").select("sentence", "words").repartition(_parts(spark), "sentence").distinct()
    scored = _scored(different, train(documents, labels, names), names)
    texts = cut(
        held.select("doc_id", "text", "sentence", "n").join(scored, "sentence")
        .groupBy("doc_id", "text").agg(F.collect_set(F.struct("sentence", "lead", "level", "seed", "n")).alias("s"))
        .select("doc_id", "text", *(F.col(f"s.{x}").alias(x) for x in ("lead", "level", "seed", "n")))
    )
    at = _thresholds(held, texts, labels, names)

    def decide(batches):
        for pdf in batches:
            rows = [(row.doc_id, s) for row in pdf.itertuples(index=False) for s in _treated(_unpacked(row, names), at)]
            yield pd.DataFrame(rows, columns=["doc_id", "subject"])

    return texts.mapInPandas(decide, "doc_id bigint, subject string").distinct()


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return document_subjects(spread(table(spark, sf, "documents").select("doc_id", "text")), table(spark, sf, "subject_labels"), table(spark, sf, "subjects"))


QUERIES = {"p9_found": p9_found}
ORACLES: dict[str, str] = {}
