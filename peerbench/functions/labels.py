"""Labels of files, sheets, flags and report rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from peerbench.constants import FILE_SECTORS, FLAG_MARK, SECTOR_FILE_PATTERNS
from peerbench.functions.text import has_any, norm_key, null_token


def sheet_has(sheet: Column, words: Sequence[str]) -> Column:
    return has_any(F.lower(sheet), words)


def flag_set(c: Column) -> Column:
    return F.coalesce(norm_key(c) == FLAG_MARK, F.lit(False))


def sector_of_file(file: Column) -> Column:
    """Sector named by a file, null where the name fits none."""
    out = None
    for sector, any_of, all_of, none_of in FILE_SECTORS:
        fits = has_any(file, any_of) if any_of else F.lit(True)
        for word in all_of:
            fits = fits & file.contains(word)
        for word in none_of:
            fits = fits & ~file.contains(word)
        out = F.when(fits, sector) if out is None else out.when(fits, sector)
    return out


def fits_word(file: Column, word: str) -> Column:
    """Does a file's name fit any pattern of a known sector word?"""
    hits = [file.rlike(f"(?i){p}") for p in SECTOR_FILE_PATTERNS[word]]
    return hits[0] if len(hits) == 1 else hits[0] | hits[1]


def file_fits_sector(file: Column, sector: Column) -> Column:
    """Does a file belong to a requested sector word?"""
    word = F.lower(F.trim(sector))
    known = None
    for key in SECTOR_FILE_PATTERNS:
        hit = fits_word(file, key)
        known = F.when(word == key, hit) if known is None else known.when(word == key, hit)
    return known.otherwise(F.contains(F.lower(file), word))


def entity_name(holding: Column, universe: Column, entity_id: Column) -> Column:
    """Holding, else universe, else a name made from the id."""
    def usable(c: Column) -> Column:
        t = null_token(c)
        return F.when(F.length(t) > 2, t)

    return F.coalesce(usable(holding), usable(universe), F.concat(F.lit("Company_"), entity_id))
