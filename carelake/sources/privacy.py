"""Raw rows -> lake rows: what leaves the drop zone holds no direct identifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake import schemas
from carelake.functions import privacy

# Columns that must never reach the lake, under any name the drops give them.
IDENTIFYING = frozenset({"patient_id", "nir", "nom", "prenom", "birth_date"})


def _text(name: str) -> Column:
    return F.coalesce(privacy.strip(F.col(name)), F.lit("")).alias(name)


def _lineage(raw: DataFrame) -> list[str]:
    return [c for c in ("malformed", "source_date", "source_file") if c in raw.columns]


def patients(raw: DataFrame, secret: str, hex_chars: int = privacy.PSEUDONYM_HEX_CHARS) -> DataFrame:
    """Pseudonym, year of birth, tidy sex and region; everything else stays behind."""
    key = privacy.pseudonym_key(raw.sparkSession, secret)
    return guard(raw.select(
        privacy.pseudonymize(F.col("patient_id"), key, hex_chars).alias("patient_pseudo_id"),
        F.coalesce(privacy.birth_year(F.col("birth_date")).cast("string"), F.lit("")).alias("birth_year"),
        F.upper(_text("sex")).alias("sex"),
        _text("region_code"),
        *_lineage(raw),
    ))


def sejours(raw: DataFrame, secret: str, hex_chars: int = privacy.PSEUDONYM_HEX_CHARS) -> DataFrame:
    """P5: the same pseudonym as the patients', so the two still join; other columns are tidied."""
    kept = [c for c in schemas.RAW_TEXT["sejours"] if c not in IDENTIFYING and c in raw.columns]
    key = privacy.pseudonym_key(raw.sparkSession, secret)
    pseudonym = privacy.pseudonymize(F.col("patient_id"), key, hex_chars).alias("patient_pseudo_id")
    return guard(raw.select(kept[0], pseudonym, *kept[1:], *_lineage(raw)).withColumns(
        {c: _text(c) for c in kept}))


def guard(lake: DataFrame) -> DataFrame:
    """Fail before anything is written if an identifying column is among the columns."""
    leaked = sorted(IDENTIFYING & {c.lower() for c in lake.columns})
    if leaked:
        raise ValueError(f"identifying columns would reach the lake: {', '.join(leaked)}")
    return lake


def to_lake(
    kind: str, raw: DataFrame, secret: str, hex_chars: int = privacy.PSEUDONYM_HEX_CHARS,
) -> DataFrame:
    """Lake rows of one kind. Kinds without personal columns pass through unchanged."""
    if kind == "patients":
        return patients(raw, secret, hex_chars)
    if kind == "sejours":
        return sejours(raw, secret, hex_chars)
    return guard(raw)
