"""Line-first quality rules: judge each line, drop those that fail, then reject documents that lose too much.

Everything is one projection over each row's own arrays: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import SPACE_CLASS, once, words

SYMBOLS = r"[#*$%&|<>]"
#: Phrases of lines that no article is made of, in the languages of the corpus (fixed values).
BOILERPLATE = (
    r"(?i)\b(all rights reserved|cookie policy|privacy policy|terms of (use|service)|click here|sign (in|up)|log ?in|subscribe now|enable javascript|skip to content|back to top|read more"
    r"|alle rechte vorbehalten|datenschutzerklärung|impressum|hier klicken|jetzt anmelden|weiterlesen|zum seitenanfang"
    r"|tous droits réservés|politique de confidentialité|mentions légales|cliquez ici|se connecter|lire la suite|haut de page"
    r"|todos los derechos reservados|política de privacidad|aviso legal|haga clic aquí|iniciar sesión|leer más|volver arriba)\b"
)
#: Marks of sentences and clauses, of other scripts too (fixed values).
PUNCTUATION = "[.,;:!?…。、，！？；：؟،؛।]"

MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
MAX_LOST = 0.5


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_fails(line: Column) -> Column:
    """True for a line that breaks a rule; a blank line breaks none."""
    n = F.greatest(F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(1))
    symbols = F.regexp_count(line, F.lit(SYMBOLS))
    separators = F.regexp_count(line, F.lit(r"[|»›·]"))
    capitals, small = F.regexp_count(line, F.lit(r"\p{Lu}")), F.regexp_count(line, F.lit(r"\p{Ll}"))
    unpunctuated = (n >= 8) & ~line.rlike(PUNCTUATION)
    shouted = (n >= 3) & (capitals > 2 * small) & (capitals >= 10) | (F.regexp_count(line, F.lit("!!")) * 3 >= n) & (n >= 3)
    navigation = (separators >= 3) & (separators * 4 >= n)
    boilerplate = (n <= 30) & line.rlike(BOILERPLATE)
    return unpunctuated | shouted | navigation | boilerplate | (symbols * 5 > n) & (symbols >= 3)


def repeated_words(rows: DataFrame, n_words: str, word_array: str, out: str) -> DataFrame:
    """Add the number of words inside 3-word windows that occur twice or more in the row.

    Hashes of the windows carry their position in the low bits; after sorting, equal hashes are neighbours.
    """
    w, n = F.col(word_array), F.col(n_words)
    grams = F.transform(
        F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>")), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    )
    rows = rows.withColumn("__grams", grams)
    g = F.col("__grams")
    bits = F.length(F.bin(n)).cast("int")
    rows = rows.withColumn("__bits", bits).withColumn("__twice", F.size(F.array_distinct(g)) < F.size(g))
    b = F.col("__bits")
    tagged = F.sort_array(F.transform(g, lambda h, i: F.call_function("shiftleft", F.call_function("shiftright", h, b), b).bitwiseOR(i.cast("long"))))
    rows = rows.withColumn("__sorted", F.when(F.col("__twice"), tagged))
    s = F.col("__sorted")

    low = F.call_function("shiftleft", F.lit(1).cast("long"), b) - 1

    def place(x: Column) -> Column:
        return x.bitwiseAND(low).cast("int")

    def same(x, y):
        """Equal in what is left of the hashes, and then in their words."""
        return F.coalesce((F.call_function("shiftright", x.bitwiseXOR(y), b) == 0) & (F.slice(w, place(x) + 1, F.lit(3)) == F.slice(w, place(y) + 1, F.lit(3))), F.lit(False))

    found = F.filter(s, lambda x, i: F.when(i > 0, same(x, F.get(s, i - 1))).otherwise(False) | same(x, F.get(s, i + 1)))
    at = F.sort_array(F.transform(found, place))
    rows = rows.withColumn("__at", at)
    p = F.col("__at")
    covered = F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))), F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.withColumn(out, F.coalesce(covered, F.lit(0).cast("long"))).drop("__grams", "__bits", "__twice", "__sorted", "__at")


def judge(docs: DataFrame, *, text_col: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """Add to every row: q_words, q_word_chars, q_symbols, q_dup_lines, q_repeat_words (long), q_base_failed,
    q_kept (boolean), q_clean (text without failing lines, null for a null text), q_lost (words removed).

    A row fails the base rules with under 50 words or over half its words inside repeated 3-word windows; else it
    is kept unless its failing lines hold more than max_lost of its words. Null and empty texts have no words and
    fail. Rows are judged one by one, so repeated rows come out alike; other columns stay; an empty table gives
    no rows.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.withColumns({"__text": text, "__words": words(text), "__lines": _lines(text)})
    lines = F.col("__lines")
    spoken = F.filter(lines, lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumns({"q_words": F.size("__words"), "__spoken": spoken, "__good": F.filter(lines, lambda x: ~line_fails(x))})
    rows = repeated_words(rows, "q_words", "__words", "q_repeat_words")
    clean = F.array_join("__good", "\n")
    rows = rows.withColumns(
        {
            "q_word_chars": (F.length("__text") - F.regexp_count("__text", F.lit(SPACE_CLASS))).cast("long"),
            "q_symbols": F.regexp_count("__text", F.lit(SYMBOLS)).cast("long"),
            "q_dup_lines": (F.size("__spoken") - F.size(F.array_distinct("__spoken"))).cast("long"),
            "q_clean": F.when(F.size("__good") == F.size("__lines"), docs[text_col]).otherwise(clean),
        }
    )
    rows = rows.withColumn("q_lost", (F.col("q_words") - F.when(F.size("__good") == F.size("__lines"), F.col("q_words")).otherwise(F.regexp_count("q_clean", F.lit(r"[^\x20\x09-\x0D]+")))).cast("long"))
    rows = rows.withColumns({"q_words": F.col("q_words").cast("long")})
    failed = (F.col("q_words") < MIN_WORDS) | (100 * F.col("q_repeat_words") > MAX_REPEATED_PERCENT * F.col("q_words"))
    rows = rows.withColumn("q_base_failed", failed)
    rows = rows.withColumn("q_kept", ~F.col("q_base_failed") & (F.col("q_lost") <= max_lost * F.col("q_words")))
    made = [c for c in rows.columns if c.startswith("q_") and c not in docs.columns]
    return once(rows.select(*docs.columns, *[F.col(c).alias(f"__{c}") for c in made]), **{c: F.col(f"__{c}") for c in made}).drop(*[f"__{c}" for c in made])
