"""One study's pipeline as an object: the load -> clean chain of the reports.

    study = PanelStudy(roster, responses, repair)
    participants = study.participants()          # root <- hope <- outcomes <- satisfaction
    table = reports.quarterly_table(study.root())

Every method returns a lazy DataFrame; nothing is computed or cached until an
action runs.  ``materialized()`` writes the joined panel once (parquet in the
session's shared checkpoint folder, partitioned by wave) for pipelines that
read it many times.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from ..codebook import DEFAULT_CODEBOOK, Codebook
from . import fused, pipeline, reports


@dataclass(frozen=True)
class PanelStudy:
    roster: DataFrame
    responses: DataFrame
    repair: DataFrame | None = None
    book: Codebook = DEFAULT_CODEBOOK
    joined_panel: DataFrame | None = None

    def joined(self) -> DataFrame:
        """Responses with the roster fields of their survey row."""
        if self.joined_panel is not None:
            return self.joined_panel
        return pipeline.join_panel(self.roster, self.responses, self.book)

    def surveys(self) -> DataFrame:
        """Every roster row with its answers, if any."""
        return pipeline.survey_rows(self.roster, self.responses, self.book)

    def materialized(self, name: str = "panel") -> "PanelStudy":
        """The same study reading a written copy of the joined panel.

        Responses have some hundred columns, so the roster's fields are sent to
        them (``colocated.attached``), not both to where the join is."""
        from ..sources.colocated import attached
        from ..sources.snapshots import materialize

        form = None
        if self.joined_panel is None:
            form = lambda: attached(self.responses, pipeline.roster_fields(self.roster, self.book), self.book.response_col)
        return replace(self, joined_panel=materialize(self.joined(), name, (self.book.wave_col,), form))

    def colocated(self, buckets: int | None = None) -> "PanelStudy":
        """The same study reading roster and responses from buckets of the
        response id: they are joined without an exchange, by as many studies
        and reports as there are.  (Buckets of the participant would put a
        participant with a third of all rows into one task.)"""
        from ..sources.colocated import bucketed

        key = [self.book.response_col]
        # roster rows without a response id join nothing; they would fill one bucket
        known = self.roster.filter(self.roster[key[0]].isNotNull())
        return replace(self, joined_panel=pipeline.join_panel(bucketed(known, "roster", key, buckets),
                                                              bucketed(self.responses, "responses", key, buckets), self.book))

    def root(self) -> DataFrame:
        """One row per participant: consolidated baseline variables."""
        return pipeline.construct_root(self.joined(), self.book)

    def hope(self, nested: bool = True) -> DataFrame:
        """Employment-hope scores per participant x wave (nested per participant)."""
        if nested:
            return pipeline.construct_hope(self.surveys(), self.repair, self.book)
        return pipeline.hope_per_wave(self.surveys(), self.repair, self.book)

    def outcomes(self, dedup: bool = False) -> DataFrame:
        """Employment outcomes per response, filled within participant x wave."""
        return pipeline.construct_outcomes(self.joined(), self.book, dedup=dedup)

    def satisfaction(self) -> DataFrame:
        """Programme satisfaction top-box flags, wave 2 full-joined to wave 3."""
        return pipeline.construct_satis(self.responses, self.book)

    def participants(self) -> DataFrame:
        """The assembled participant table (root <- hope <- outcomes <- satisfaction).

        One pass over roster and responses; a study that reads a written panel
        joins its four tables instead."""
        if self.joined_panel is None:
            return fused.participants(self.roster, self.responses, self.repair, self.book)
        outcomes = pipeline.nest_outcomes(self.outcomes(dedup=True), self.book)
        return pipeline.assemble(self.root(), self.hope(), outcomes, self.satisfaction(), self.book.id_col)

    def population(self, **kwargs) -> DataFrame:
        """Participants of one province report."""
        return reports.report_population(self.root(), **kwargs)
