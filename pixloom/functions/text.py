"""Captions, prompts, tokens and constraints of texts, as column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from pixloom.functions.parsing import as_col

# Fixed value: characters that the alt-text length leaves out.
SEPARATORS = "[，。！？“”‘’：；、【】《》\\s\\p{Z},.!?\"':;\\[\\]<>]"
CHINESE = r"[\x{4e00}-\x{9fff}]"

# Tags around captions.
NATIVE = ("<|native_caption_start|>", "<|native_caption_end|>")
RECAPTION = ("<|recaption_start|>", "<|recaption_end|>")


def _quoted(tag: str) -> str:
    return tag.replace("|", r"\|")


def alttext_length(c: Column | str) -> Column:
    """Length of the stripped text less the number of separators in the whole text (outer blanks count twice)."""
    t = as_col(c)
    return F.length(F.regexp_replace(t, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")) - F.regexp_count(t, F.lit(SEPARATORS))


def captions(c: Column | str) -> Column:
    """(native, recaption) of a tagged caption: both, the new one, the native one, or the text itself as native."""
    t = as_col(c)
    n, r = (f"{_quoted(a)}(.*){_quoted(b)}" for a, b in (NATIVE, RECAPTION))
    both = f"(?s)^{n}{r}$"
    is_both, is_r, is_n = t.rlike(both), t.rlike(f"(?s)^{r}$"), t.rlike(f"(?s)^{n}$")
    native = F.when(is_both, F.regexp_extract(t, both, 1)).when(is_r, F.lit(None)).when(is_n, F.regexp_extract(t, f"(?s)^{n}$", 1)).otherwise(t)
    new = F.when(is_both, F.regexp_extract(t, both, 2)).when(is_r, F.regexp_extract(t, f"(?s)^{r}$", 1))
    return F.struct(native.alias("native"), new.alias("recaption"))


def fill(template: str, **values: Column) -> Column:
    """The template with each ``{name}`` replaced; a null value as an empty text."""
    out = F.lit(template)
    for name, v in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(v, F.lit("")))
    return out


def has_chinese(c: Column | str) -> Column:
    return as_col(c).rlike(CHINESE)


def ocr_tokens(c: Column | str, keep_blank: bool = True, lower: bool = True, alnum: bool = False) -> Column:
    """Tokens of recognised text: blank-separated words, or single characters without blanks."""
    t = F.regexp_replace(F.replace(F.replace(as_col(c), F.lit("###"), F.lit("")), F.lit("***"), F.lit("")), r"[\s\p{Z}]+", " ")
    parts = F.split(t, " ") if keep_blank else F.split(F.replace(t, F.lit(" "), F.lit("")), "")
    if lower:
        parts = F.transform(parts, F.lower)
    if alnum:
        parts = F.transform(parts, lambda x: F.regexp_replace(x, "[^A-Za-z0-9]+", ""))
    return F.filter(parts, lambda x: x != "")


def half_width(c: Column | str) -> Column:
    """Full-width forms of ASCII as ASCII, the wide blank as a blank; blanks beside Chinese characters dropped."""
    wide = "".join(chr(0xFF01 + k) for k in range(94)) + "　"
    plain = "".join(chr(0x21 + k) for k in range(94)) + " "
    t = F.translate(as_col(c), wide, plain)
    return F.regexp_replace(F.regexp_replace(t, f"({CHINESE}) +", "$1"), f" +({CHINESE})", "$1")


@dataclass(frozen=True)
class Style:
    """How a chat is written down: what follows the system text (``head``: always the separator, only after a text, never), what stands
    between role and text, what ends a turn (``one`` separator, ``two`` in turn, or a literal), and what follows the role of
    an open turn."""

    head: str
    infix: str
    end: str
    open: str
    role: bool = True
    odd_tail: str = ""
    tail: str = ""
    rounds: bool = False


# The public chat styles.
STYLES = {
    "single": Style("always", ": ", "one", ":"),
    "two": Style("always", ": ", "two", ":"),
    "colon_space": Style("always", ": ", "one", ": "),
    "falcon": Style("if", ": ", "one", ":"),
    "newline": Style("if", "\n", "one", "\n"),
    "no_colon": Style("never", "", "one", ""),
    "no_colon_two": Style("never", "", "two", ""),
    "mpt": Style("always", "", "one", ""),
    "plain": Style("never", "", "two", "", role=False),
    "rwkv": Style("never", ": ", "\n\n", ":"),
    "rounds": Style("if", "：", "one", "：", rounds=True),
    "spaced": Style("never", "\n ", "", ""),
    "intern": Style("never", ":", "two", ":", tail="\n"),
    "dolly": Style("never", ":\n", "two", ":\n", odd_tail="\n\n"),
    "phoenix": Style("never", ": <s>", "</s>", ": <s>"),
    "robin": Style("always", ":\n", "one", ":\n"),
}


def turns_to_prompt(turns: Column, style: str, system: str = "", sep: str = "\n", sep2: str = "</s>") -> Column:
    """A dialogue (array of role, text in order) in one of ``STYLES``, in ``chatml`` (fenced roles) or in ``inst`` (user
    turns in instruction brackets, the system text inside the first). A null or empty text leaves an open turn."""
    has = lambda m: F.coalesce(F.length(m["text"]) > 0, F.lit(False))
    if style == "chatml":
        start = lambda m: F.concat(F.lit("<|im_start|>"), m["role"], F.lit("\n"))
        turn = lambda m, i: F.concat(start(m), F.when(has(m), F.concat(m["text"], F.lit("<|im_end|>\n"))).otherwise(""))
        return F.concat(F.lit(f"<|im_start|>system\n{system}<|im_end|>\n" if system else ""), F.array_join(F.transform(turns, turn), ""))
    if style == "inst":
        wrapped = f"<<SYS>>\n{system}\n<</SYS>>\n\n" if system else ""

        def turn(m, i):
            asked = F.concat(F.lit("[INST] "), F.when(i == 0, wrapped).otherwise(""), m["text"], F.lit(" [/INST]"))
            return F.when(~has(m), "").when(m["role"] == "user", asked).otherwise(F.concat(F.lit(" "), m["text"], F.lit(f" {sep2}")))

        return F.array_join(F.transform(turns, turn), "")
    s = STYLES[style]

    def turn(m, i):
        odd = i % 2 == 1
        end = {"one": F.lit(sep), "two": F.when(odd, sep2).otherwise(sep)}.get(s.end, F.lit(s.end))
        text = F.replace(F.replace(m["text"], F.lit("\r\n"), F.lit("\n")), F.lit("\n\n"), F.lit("\n")) if style == "rwkv" else m["text"]
        role = m["role"] if s.role else F.lit("")
        number = F.when(odd, "").otherwise(F.concat(F.lit("[Round "), F.floor(i / 2).cast("string"), F.lit(f"]{sep}"))) if s.rounds else F.lit("")
        full = F.concat(role, F.lit(s.infix), text, end, F.lit(s.tail), F.when(odd, s.odd_tail).otherwise(""))
        return F.concat(number, F.when(has(m), full).otherwise(F.concat(role, F.lit(s.open))))

    head = system + (sep if s.head == "always" or (s.head == "if" and system) else "")
    return F.concat(F.lit(head), F.array_join(F.transform(turns, turn), ""))


def expand_image(c: Column | str, tiles: Column, tokens: int = 256) -> Column:
    """The first ``<image>`` as an opened and closed run of ``tiles x tokens`` context tokens."""
    t = as_col(c)
    at = F.instr(t, F.lit("<image>"))
    run = F.concat(F.lit("<img>"), F.repeat(F.lit("<ctx>"), (tiles * tokens).cast("int")), F.lit("</img>"))
    return F.when(at > 0, F.concat(F.substr(t, F.lit(1), at - 1), run, F.substr(t, at + 7))).otherwise(t)


def left_images(c: Column | str) -> Column:
    """Number of ``<image>`` marks still unexpanded."""
    return F.regexp_count(as_col(c), F.lit("<image>"))


def mask_labels(lengths: Column, asked: Column) -> Column:
    """Label mask of a dialogue: ``-100`` for the tokens of asked turns, the token's position elsewhere.

    ``lengths`` are token counts of the turns, ``asked`` says which are not learnt."""
    total = F.aggregate(lengths, F.lit(0), lambda a, x: a + x.cast("int"))
    flags = F.flatten(F.zip_with(lengths, asked, lambda n, q: F.array_repeat(q, n.cast("int"))))
    return F.when(total == 0, F.array().cast("array<int>")).otherwise(F.transform(flags, lambda q, i: F.when(q, F.lit(-100)).otherwise(i)))


def left_pad(ids: Column, width: Column, pad: int = 0) -> Column:
    """(ids, mask) padded on the left to ``width``."""
    gap = (width - F.size(ids)).cast("int")
    mask = F.concat(F.array_repeat(F.lit(0), gap), F.array_repeat(F.lit(1), F.size(ids)))
    return F.struct(F.concat(F.array_repeat(F.lit(pad), gap), ids).alias("ids"), mask.alias("mask"))


def paragraphs(c: Column | str) -> Column:
    return F.filter(F.split(as_col(c), r"\n[ \t]*\n|\n"), lambda p: F.trim(p) != "")


def sentences(c: Column | str) -> Column:
    return F.filter(F.split(as_col(c), r"[.!?。！？]+"), lambda s: F.trim(s) != "")


def decimals_ok(c: Column | str, places: int) -> Column:
    """Every decimal number has exactly ``places`` digits after its point; true without any."""
    return F.forall(F.regexp_extract_all(as_col(c), F.lit(r"[0-9]+\.([0-9]+)"), F.lit(1)), lambda d: F.length(d) == places)
