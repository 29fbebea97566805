"""Column-expression helpers (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The numeric grammar accepted by the coercing parse.  A value is
# numeric when it is a plain decimal / scientific literal or an inf/nan word,
# surrounded by optional blanks.  Anything else (``'1d'``, ``'1_000'``,
# ``'0x1F'``, ``''``) is missing, which the caller then fills.
NUMERIC_PATTERN = (
    r"^[ \t\n\r\f]*[+-]?(([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?"
    r"|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])[ \t\n\r\f]*$"
)

# Protein-altering variant classes kept by the mutation job.
MEANINGFUL_VARIANTS = [
    "Frame_Shift_Del", "Frame_Shift_Ins", "In_Frame_Del", "In_Frame_Ins",
    "Missense_Mutation", "Nonsense_Mutation", "Splice_Site",
    "Translation_Start_Site", "Nonstop_Mutation",
]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    c = _c(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def coerce_numeric(c, default: float | None = 0.0, is_string: bool = True) -> Column:
    """Coercing parse: text -> double; unparsable, NaN and NULL -> ``default``.

    ``try_cast`` alone accepts Java suffixes such as ``'1d'``; the regex guard
    removes them so the result follows the usual CSV numeric grammar.
    """
    c = _c(c)
    if is_string:
        parsed = F.when(c.rlike(NUMERIC_PATTERN), strip_ws(c).try_cast("double"))
    else:
        parsed = c.cast("double")
    parsed = nan_to_null(parsed)
    return parsed if default is None else F.coalesce(parsed, F.lit(float(default)))


def strip_ws(c) -> Column:
    """Strip all surrounding whitespace (``trim`` removes spaces only)."""
    return F.regexp_replace(_c(c), r"^[ \t\n\r\f\u000B]+|[ \t\n\r\f\u000B]+$", "")


def normalise_key(c) -> Column:
    """Key normalisation: text form, upper case.  NULL stays NULL (drop later)."""
    return F.upper(_c(c).cast("string"))


def log2p1(c) -> Column:
    return F.log2(_c(c) + F.lit(1.0))


def threshold(c, cut: float = 0.5) -> Column:
    return (_c(c) > F.lit(cut)).cast("int")


def modality_from_suffix(c) -> Column:
    """Last ``_`` token, whole text when there is no ``_``."""
    return F.substring_index(_c(c), "_", -1)


def modality_from_pred(c, other: str = "other_omics") -> Column:
    """Second ``_`` token of ``pred_<m>_...`` names, else ``other``."""
    c = _c(c)
    return F.when(c.startswith("pred_"),
                  F.coalesce(F.try_element_at(F.split(c, "_"), F.lit(2)), F.lit("")))\
        .otherwise(F.lit(other))


def modality_from_binary_pred(c) -> Column:
    """``pred_<m>_cancer_prob`` / ``pred_<m>_normal_prob`` -> ``<m>``."""
    c = _c(c)
    stripped = F.replace(F.replace(F.replace(c, F.lit("pred_"), F.lit("")),
                                   F.lit("_cancer_prob"), F.lit("")),
                         F.lit("_normal_prob"), F.lit(""))
    return F.when(c.startswith("pred_"), stripped).otherwise(c)


def modality_from_filename(c, prefix: str = "oof_preds_", suffix: str = "_binary.csv") -> Column:
    c = _c(c)
    return F.replace(F.replace(c, F.lit(prefix), F.lit("")), F.lit(suffix), F.lit(""))


def pred_column_name(modality, klass) -> Column:
    m = F.lit(modality) if isinstance(modality, str) else modality
    return F.concat_ws("_", F.lit("pred"), m, _c(klass).cast("string"))


def category_sample_id(sample, category) -> Column:
    """``<sample>_NORMAL`` / ``<sample>_CANCER``."""
    return F.concat_ws("_", _c(sample).cast("string"), F.upper(_c(category)))


def prefixed_feature(modality, feature) -> Column:
    m = F.lit(modality) if isinstance(modality, str) else modality
    return F.concat(m, F.lit("_"), _c(feature))


def pca_component_name(modality: str, index) -> Column:
    return F.format_string(f"{modality}_PCA_PC%d", _c(index))
