"""The library's front door: laws, versions, sections as of a date, differences.

``LawStore`` works on section rows (abbrev, fassung_vom, section_id, heading, body, section_type, arrival) and, if
given, on commits and a catalog, which bring names, amendments and ids. Everything returned is a DataFrame; unknown laws and dates raise ``LookupError``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions.law_text import section_sort_key
from .operators import catalog as cat
from .operators import diffing
from .operators import versions as ver
from .sources.stored import stored

RED, GREEN, BOLD, PLAIN = "\033[31m", "\033[32m", "\033[1m", "\033[0m"


class LawStore:
    """``commits``: abbrev, fassung_vom, version_id, aenderung, message. ``catalog``: gsn, name, abbrev, typ, cat_id.

    ``listed``: abbreviations (column abbrev) that ``law`` marks as synthetic. Laws are found in the catalog by gsn,
    which is the abbreviation unless ``gsn_of`` (abbrev, gsn) tells otherwise.
    """

    def __init__(self, rows: DataFrame, commits: DataFrame | None = None, catalog: DataFrame | None = None, listed: DataFrame | None = None, gsn_of: DataFrame | None = None) -> None:
        self.snapshot = stored(ver.build_snapshot(rows))
        self.versions_table = stored(ver.versions_of(rows))
        self.commits, self.listed = commits, listed
        self.names = None
        if catalog is not None:
            laws = self.versions_table.select("abbrev").distinct()
            laws = laws.join(gsn_of, "abbrev") if gsn_of is not None else laws.withColumn("gsn", F.col("abbrev"))
            self.names = stored(cat.law_names_fallback(laws, catalog).select("abbrev", "name"))
        self._sections: DataFrame | None = None

    @property
    def sections(self) -> DataFrame:
        """Normalised sections of every version."""
        if self._sections is None:
            self._sections = stored(ver.normalize_sections(self.snapshot.join(self.versions_table, ver.VERSION)))
        return self._sections

    def laws(self, search: str = "") -> DataFrame:
        """abbrev, name, versions, newest_fassung_vom of the laws whose abbreviation or name has ``search`` in it, case aside."""
        found = self.versions_table.groupBy("abbrev").agg(F.count("*").alias("versions"), F.max("fassung_vom").alias("newest_fassung_vom"))
        found = found.join(self.names, "abbrev", "left") if self.names is not None else found.withColumn("name", F.lit(""))
        found = found.select("abbrev", F.coalesce("name", F.lit("")).alias("name"), "versions", "newest_fassung_vom")
        return found.where(F.lower("abbrev").contains(search.lower()) | F.lower("name").contains(search.lower())).orderBy("abbrev")

    def law(self, abbrev: str) -> dict:
        """A law's abbreviation, name, number of versions and of sections, whether it is listed, and versions_list.

        versions_list is a DataFrame, newest first: fassung_vom, aenderung, short_id, sections (for the newest version
        only, as reconstructed), changed_count, changed_sections (30 at most, in natural order). Of several commits of
        one date the newest counts.
        """
        versions = self.versions(abbrev)
        newest = versions.first()
        sections = self.sections.where(F.col("abbrev") == abbrev)
        changed = ver.changed_lists(sections).select("fassung_vom", F.size("changed").alias("changed_count"), F.slice("changed", 1, 30).alias("changed_sections"))
        total = self.as_of(abbrev, newest.fassung_vom).count()
        commits = None
        if self.commits is not None:
            mine = self.commits.where(F.col("abbrev") == abbrev).groupBy("fassung_vom").agg(F.max_by(F.struct("aenderung", "message"), "version_id").alias("c"))
            commits = mine.select("fassung_vom", "c.aenderung", ver.short_id(F.md5(F.col("c.message").cast("binary"))).alias("short_id"))
        listed = versions.select("fassung_vom").join(changed, "fassung_vom", "left")
        listed = listed.join(commits, "fassung_vom", "left") if commits is not None else listed.withColumns({"aenderung": F.lit(None).cast("string"), "short_id": F.lit(None).cast("string")})
        listed = listed.withColumn("sections", F.when(F.col("fassung_vom") == newest.fassung_vom, F.lit(total)))
        return {
            "abbrev": abbrev,
            "name": self.laws(abbrev).where(F.col("abbrev") == abbrev).first()["name"],
            "versions_count": versions.count(),
            "sections": total,
            "synthetic": self.listed is not None and not self.listed.where(F.col("abbrev") == abbrev).isEmpty(),
            "versions_list": listed.select("fassung_vom", "aenderung", "short_id", "sections", F.coalesce("changed_count", F.lit(0)).alias("changed_count"), "changed_sections").orderBy(F.desc("fassung_vom")),
        }

    def versions(self, abbrev: str) -> DataFrame:
        """The versions of a law, newest first."""
        v = self.versions_table.where(F.col("abbrev") == abbrev)
        if v.isEmpty():
            raise LookupError(f"unknown law {abbrev!r}")
        return v.orderBy(F.desc("fassung_vom"))

    def _seq(self, abbrev: str, date: str) -> DataFrame:
        at = self.versions(abbrev).where(F.col("fassung_vom") == date).select("abbrev", "seq")
        if at.isEmpty():
            raise LookupError(f"{abbrev!r} has no version of {date!r}")
        return at

    def as_of(self, abbrev: str, date: str) -> DataFrame:
        """The reconstructed sections of one version, in natural order."""
        full = ver.as_of_all(self.sections.where(F.col("abbrev") == abbrev), self._seq(abbrev, date))
        return full.orderBy(section_sort_key(F.col("section_id")), "section_id").select("section_id", "heading", "body")

    def diff(self, abbrev: str, old: str, new: str, section_id: str | None = None, section_type: str | None = None) -> DataFrame:
        """Two versions as delivered; with equal dates every section is unchanged and the filters don't matter."""
        sides = []
        for date in (old, new):
            self._seq(abbrev, date)
            sides.append(self.snapshot.where((F.col("abbrev") == abbrev) & (F.col("fassung_vom") == date)))
        only = {} if old == new else {"section_id": section_id, "section_type": section_type}
        return diffing.diff_sections(*sides, ["abbrev"], **only).orderBy("section_id")

    def diff_as_of(self, abbrev: str, old: str, new: str) -> DataFrame:
        """Two versions as reconstructed, with display headings; no rows for equal dates."""
        sides = [ver.as_of_all(self.sections.where(F.col("abbrev") == abbrev), self._seq(abbrev, d)) for d in (old, new)]
        shown = diffing.diff_as_shown(*sides, ["abbrev"]).orderBy(section_sort_key(F.col("section_id")), "section_id")
        return shown.limit(0) if old == new else shown

    def changes(self, abbrev: str) -> DataFrame:
        """What each version of a law changed."""
        self.versions(abbrev)
        return ver.changed_sections(self.sections.where(F.col("abbrev") == abbrev))


def render(diff: DataFrame, title: str, color: bool = False) -> str:
    """A difference of one law as text; its changed sections are brought to the driver."""
    red, green, bold, plain = (RED, GREEN, BOLD, PLAIN) if color else ("", "", "", "")
    lines, changed, same = [f"{bold}{title}{plain}", ""], 0, 0
    for r in diff.collect():
        if r.change_kind == "unchanged":
            same += 1
            continue
        changed += 1
        lines += [f"{bold}── {r.heading}{plain}", *([f"{red}- {r.old_body}{plain}"] if r.old_body else []), *([f"{green}+ {r.new_body}{plain}"] if r.new_body else []), ""]
    if not changed:
        lines.append("No changes." if same else "No sections found in either version.")
    return "\n".join([*lines, f"{changed} changed, {same} unchanged"])
