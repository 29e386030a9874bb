"""Reconciling an incoming provider file with the existing lookup table.

Flag and route: every candidate row has a kind (existing row, incoming row of a
known or of a new provider, known tax ID with incoming attributes). One aggregate
per tax ID says what is repeated, in conflict or taken; the rows are joined to it
once, and every branch, the rejects and the merge are filters of the result. Each
branch is a property, evaluated when asked for, and derives only the kinds of rows
it shows. Nothing is stored.

Provider names meet in a directory with a row per normalised name and health
system, holding the keys as an array that is opened last: a name with many spellings
and many rows shuffles the sum of both, not their product.

Tax IDs are tested with SQL ``NOT IN`` where the load is defined. The value lists
(repeated, conflicting, clashing tax IDs) never hold a null, so a row that has a tax
ID passes by its own flags. Rows without one pass only while the lists are empty;
only if there are such rows is that asked, with one more query.
"""

from __future__ import annotations

import datetime as dt
import functools
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.functions.cleansing import norm_name
from claimweave.functions.tins import format_tin
from claimweave.operators.keys import Numbering, latest_per_key, not_in, numbering, surrogate_keys
from claimweave.operators.providers import LOOKUP_COLUMNS, timestamp_text

# Texts of the reject file.
SAME_PROVIDER = "Different TIN Names for Same TIN belonging to same provider"
OTHER_PROVIDER = "TIN Belongs to Different Providers"

_NAME = "healthcareorganizationname"
_UNDATED = [c for c in LOOKUP_COLUMNS if c not in ("formattedtin", "refresh_date")]
_FORMATTED = [c for c in LOOKUP_COLUMNS if c != "refresh_date"]
#: What an incoming row updates of an existing one with its tax ID, and what stays.
_UPDATED = ("mpin", "tinname", "health_system_id", "pcorname", "claimsthrudate")
_KEPT = (_NAME, "providersyskey", "formattedtin")
#: Kinds of candidate rows.
_OLD, _KNOWN, _NEW, _SAME_TIN = "existing", "known provider", "new provider", "known tax ID"
#: Lanes that spread rows which need no number.
_LANES = 64


@dataclass(frozen=True)
class _State:
    """What the existing table says as a whole: whether it has rows and nameless ones, and its highest key."""

    rows: int
    named: int
    highest: int


@dataclass(frozen=True)
class _Refused:
    """Whether any tax ID is repeated or refused, for the rows without one."""

    known_repeated: bool = False
    known_conflict: bool = False
    new_repeated: bool = False
    new_taken: bool = False


class Reconciliation:
    """Branches of one incremental load.

    ``existing`` has the columns of the lookup table, ``incoming`` the same
    without key, formatted tax ID and refresh date. ``now`` becomes the refresh
    date of accepted rows.
    """

    def __init__(self, existing: DataFrame, incoming: DataFrame, now: dt.datetime | str, tin_mode: str = "reference"):
        self.existing = existing.select(*LOOKUP_COLUMNS)
        self.incoming = incoming
        self._now = timestamp_text(now)
        self._tin_mode = tin_mode
        self._directories: dict[bool, DataFrame] = {}

    # Names --------------------------------------------------------------------

    @cached_property
    def _state(self) -> _State:
        found = self.existing.agg(F.count(F.lit(1)), F.count(_NAME), F.coalesce(F.max("providersyskey"), F.lit(0))).first()
        return _State(*found)

    @cached_property
    def new_names(self) -> DataFrame:
        """Incoming rows whose provider name is unknown."""
        known = self.existing.select(norm_name(_NAME).alias("_known"))
        return not_in(self.incoming, norm_name(_NAME), known, "_known")

    @cached_property
    def _numbering(self) -> Numbering:
        known = self.existing.select(norm_name(_NAME).alias("_norm")).distinct()
        names = self.incoming.select(_NAME).distinct().withColumn("_norm", norm_name(_NAME))
        return numbering(names.where(self._is_new()).join(known, "_norm", "left_anti"), _NAME, over=self.incoming)

    @cached_property
    def new_keys(self) -> DataFrame:
        """A key for every new provider name as written, after the highest known key."""
        return surrogate_keys(self.new_names, _NAME, "providersyskey", F.lit(self._state.highest), self._numbering)

    def _is_new(self) -> Column:
        """NOT IN for a name that no existing row has: a nameless existing row lets nothing through."""
        if not self._state.rows:
            return F.lit(True)
        return F.col("_norm").isNotNull() & F.lit(self._state.named == self._state.rows)

    def _directory(self, numbered: bool) -> DataFrame:
        if numbered not in self._directories:
            self._directories[numbered] = self._names_and_keys(numbered)
        return self._directories[numbered]

    def _names_and_keys(self, numbered: bool) -> DataFrame:
        """Keys by normalised name, for rows that bring a health system (``_given``) and for rows that inherit ``_system``.

        Known names have the keys of the existing table, new ones an entry per
        spelling, with its key if ``numbered``. One pass over the names of either table.
        """
        old = self.existing.select(
            norm_name(_NAME).alias("_norm"), "providersyskey", F.col("health_system_id").alias("_system")
        )
        old = old.where(F.col("_norm").isNotNull()).distinct().withColumn("_known", F.lit(True))
        # In a struct, so that a missing name is one spelling.
        spelled = self.incoming.groupBy(norm_name(_NAME).alias("_norm")).agg(F.collect_set(F.struct(_NAME)).alias("_spellings"))
        known = F.coalesce("_known", F.lit(False))
        met = spelled.join(old, "_norm", "left").where(known | self._is_new())
        nameless = F.array(F.struct(F.lit(None).cast("string").alias(_NAME)))
        spread = F.when(known, nameless).otherwise(F.col("_spellings"))
        named = met.select("_norm", known.alias("_known"), "providersyskey", "_system", F.inline(spread))
        key = F.col("providersyskey")
        if numbered:
            elsewhere = -1 - F.pmod(F.xxhash64("_norm", "providersyskey", "_system"), F.lit(_LANES))
            lane = F.when(F.col("_known"), elsewhere).otherwise(self._numbering.bucket(_NAME).cast("long"))
            named = named.withColumn("_position", self._numbering.position(_NAME, lane) + self._state.highest)
            key = F.when(F.col("_known"), key).otherwise(F.col("_position").cast("int"))
        uses = F.array(
            F.struct(F.lit(True).alias("_given"), F.lit(None).cast("string").alias("_system")),
            F.struct(F.lit(False).alias("_given"), F.col("_system").cast("string").alias("_system")),
        )
        entry = F.struct(key.alias("providersyskey"), F.col(_NAME).alias("spelling"))
        keyed = named.select("_norm", "_known", entry.alias("_key"), F.inline(uses))
        return keyed.groupBy("_norm", "_given", "_known", "_system").agg(F.collect_set("_key").alias("_keys"))

    # Candidate rows -------------------------------------------------------------

    def _met(self, numbered: bool) -> DataFrame:
        """Incoming rows with what the directory says of their name: kind (null: neither known nor new) and keys."""
        system = self.existing.schema["health_system_id"].dataType
        rows = self.incoming.withColumns({"_norm": norm_name(_NAME), "_given": F.col("health_system_id").isNotNull()})
        return rows.join(self._directory(numbered), ["_norm", "_given"], "left").withColumns(
            {
                "_kind": F.when(F.col("_known"), _KNOWN).when(~F.col("_known"), _NEW),
                "_own_system": F.col("health_system_id"),
                "health_system_id": F.coalesce("health_system_id", F.col("_system").cast(system)),
            }
        )

    def _incoming_rows(self, kinds: set[str], numbered: bool = True) -> DataFrame:
        """Rows of known providers, once each, and of new providers, as often as they occur, with ``_kind``.

        The keys are opened with ``explode_outer``, and what has none is left out
        afterwards: so the directory is planned as for the flags, and computed once.
        """
        fields = [c for c in _UNDATED if c != "providersyskey"]
        # Known providers are compared key by key; the keys of a new one stay together until the end.
        apart = F.transform("_keys", lambda k: F.array(k))
        keys = F.explode_outer(F.when(F.col("_kind") == _KNOWN, apart).otherwise(F.array("_keys"))).alias("_opened")
        rows = self._met(numbered).select("_kind", *fields, keys)
        once = rows.where(F.col("_opened").isNotNull()).groupBy("_kind", *fields, "_opened").agg(F.count(F.lit(1)).alias("_copies"))
        once = once.where(F.col("_kind").isin(*kinds))
        if _NEW in kinds:
            times = F.when(F.col("_kind") == _NEW, F.col("_copies")).otherwise(F.lit(1))
            once = once.withColumn("_copies", F.explode(F.sequence(F.lit(1).cast("long"), times)))
        return once.select("_kind", *fields, F.inline("_opened")).select("_kind", *_UNDATED)

    @cached_property
    def existing_provider(self) -> DataFrame:
        """Incoming rows of known providers, with the known key; a missing health system is the known one."""
        return self._incoming_rows({_KNOWN}).select(*_UNDATED)

    @cached_property
    def new_provider(self) -> DataFrame:
        """Incoming rows of new providers with their keys; each spelling of a name has its own."""
        return self._incoming_rows({_NEW}).withColumn("formattedtin", format_tin("tin", self._tin_mode)).select(*_FORMATTED)

    @cached_property
    def existing_tin(self) -> DataFrame:
        """Known tax IDs with incoming attributes where there are any.

        The existing side is first reduced to what the result can show: an
        attribute only for incoming rows that do not bring it themselves. So
        existing variants that an incoming row overrides are not multiplied
        with it.
        """
        # One bit per attribute that an incoming row leaves open.
        missing = [F.when(F.col(c).isNull(), 1 << k).otherwise(0) for k, c in enumerate(_UPDATED)]
        new = self.incoming.select("tin", *_UPDATED).distinct()
        new = new.withColumn("_open", sum(missing[1:], missing[0]))
        asked = new.select("tin", "_open").distinct()
        shown = [
            F.when(F.col("_open").bitwiseAND(F.lit(1 << _UPDATED.index(c))) != 0, F.col(c)).alias(c) if c in _UPDATED else F.col(c)
            for c in _FORMATTED
        ]
        old = self.existing.join(asked, "tin").select("_open", *shown).distinct().alias("old")
        new = new.alias("new")
        columns = [(F.coalesce(f"new.{c}", f"old.{c}") if c in _UPDATED else F.col(f"old.{c}")).alias(c) for c in _FORMATTED]
        same = (F.col("old.tin") == F.col("new.tin")) & (F.col("old._open") == F.col("new._open"))
        return old.join(new, same).select(*columns).distinct()

    # Flags ----------------------------------------------------------------------

    def _flags(self, kinds: set[str], numbered: bool) -> DataFrame:
        """One row per tax ID with what its rows of ``kinds`` (and, for known tax IDs, all incoming rows) say.

        Minimum and maximum tell whether rows differ, so repeated rows need
        not be counted or removed first, and a tax ID with a third of all rows
        is collapsed on the map side.
        """
        sides = []
        if set(kinds) - {_OLD}:
            opened = [*self.incoming.columns, "_own_system", "_kind", F.explode_outer("_keys").alias("_key")]
            unformatted = F.lit(None).cast(self.existing.schema["formattedtin"].dataType).alias("formattedtin")
            sides.append(self._met(numbered).select(*opened).select("*", "_key.providersyskey", unformatted))
        if _OLD in kinds or _SAME_TIN in kinds:
            sides.append(self.existing.withColumn("_kind", F.lit(_OLD)))
        rows = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides).where(F.col("tin").isNotNull())

        old, known, new = (F.coalesce(F.col("_kind") == k, F.lit(False)) for k in (_OLD, _KNOWN, _NEW))
        row = F.struct(*_UNDATED)
        found = {
            "_low": F.min(F.when(known, row)),
            "_high": F.max(F.when(known, row)),
            "_news": F.count_if(new),
            "_taken": F.bool_or(old),
            "_first": F.min(F.when(old, F.col(_NAME))),
            "_last": F.max(F.when(old, F.col(_NAME))),
        }
        varies = F.lit(False)
        if _SAME_TIN in kinds:
            found |= {"_met": F.bool_or(~old), "_kept_low": F.min(F.when(old, F.struct(*_KEPT))), "_kept_high": F.max(F.when(old, F.struct(*_KEPT)))}
            varies = ~F.col("_kept_low").eqNullSafe(F.col("_kept_high"))
            for c in _UPDATED:
                own = F.col("_own_system" if c == "health_system_id" else c)
                found |= {
                    f"_open_{c}": F.bool_or(~old & own.isNull()),
                    f"_new_low_{c}": F.min(F.when(~old & own.isNotNull(), F.struct(own.alias("v")))),
                    f"_new_high_{c}": F.max(F.when(~old & own.isNotNull(), F.struct(own.alias("v")))),
                    f"_old_low_{c}": F.min(F.when(old, F.struct(F.col(c).alias("v")))),
                    f"_old_high_{c}": F.max(F.when(old, F.struct(F.col(c).alias("v")))),
                }
                # The values that the column can take: incoming ones, and existing ones where an incoming row leaves it open.
                low = F.least(f"_new_low_{c}", F.when(F.col(f"_open_{c}"), F.col(f"_old_low_{c}")))
                high = F.greatest(f"_new_high_{c}", F.when(F.col(f"_open_{c}"), F.col(f"_old_high_{c}")))
                varies = varies | ~low.eqNullSafe(high)
            varies = F.col("_met") & F.col("_taken") & varies
        flags = rows.groupBy(F.col("tin").alias("_tin")).agg(*[a.alias(n) for n, a in found.items()])
        single = F.col("_low").isNotNull() & F.col("_low").eqNullSafe(F.col("_high"))
        other = (F.col("_first") != F.col(f"_low.{_NAME}")) | (F.col("_last") != F.col(f"_low.{_NAME}"))
        return flags.select(
            "_tin",
            F.when(single, F.col("_low")).alias("_single"),
            (F.col("_low").isNotNull() & ~single).alias("_known_repeated"),
            F.coalesce(single & other, F.lit(False)).alias("_known_conflict"),
            F.coalesce(F.col("_news") > 1, F.lit(False)).alias("_new_repeated"),
            F.coalesce(F.col("_news") == 1, F.lit(False)).alias("_new_single"),
            "_taken",
            varies.alias("_varies"),
        )

    @cached_property
    def _refused(self) -> _Refused:
        """Asked only where a row has no tax ID: such rows pass while nothing is refused."""
        if self.incoming.where(F.col("tin").isNull()).isEmpty():
            return _Refused()
        flags = self._flags({_OLD, _KNOWN, _NEW}, False)
        columns = ["_known_repeated", "_known_conflict", "_new_repeated", F.col("_new_single") & F.col("_taken")]
        found = flags.agg(*[F.coalesce(F.bool_or(c), F.lit(False)) for c in columns]).first()
        return _Refused(*found)

    # Routes ---------------------------------------------------------------------

    def _routed(self, kinds: set[str], about: set[str], numbered: bool = True) -> DataFrame:
        """Candidate rows of ``kinds``, in lookup columns, with the flags of their tax ID as far as ``about`` says."""
        sides = []
        incoming = kinds & {_KNOWN, _NEW}
        if incoming:
            sides.append(self._dated(self._incoming_rows(incoming, numbered).withColumn("formattedtin", format_tin("tin", self._tin_mode))))
        if _SAME_TIN in kinds:
            sides.append(self._dated(self.existing_tin.withColumn("_kind", F.lit(_SAME_TIN))))
        if _OLD in kinds:
            sides.append(self.existing.withColumn("_kind", F.lit(_OLD)).select("_kind", *LOOKUP_COLUMNS))
        rows = functools.reduce(DataFrame.unionByName, sides)
        return rows.join(self._flags(about, numbered), F.col("tin") == F.col("_tin"), "left")

    def _dated(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("refresh_date", F.lit(self._now)).select("_kind", *LOOKUP_COLUMNS)

    def _pass(self, *flags: str) -> Column:
        """Rows with none of the flags; of those without a tax ID all, if no tax ID has one of them."""
        own = functools.reduce(lambda a, b: a | b, [F.col("_taken") if f == "_new_taken" else F.col(f) for f in flags])
        any_ = any(getattr(self._refused, f.lstrip("_")) for f in flags)
        return F.when(F.col("tin").isNull(), F.lit(not any_)).otherwise(~own)

    def _of(self, kind: str) -> Column:
        return F.col("_kind") == kind

    # Providers that are already known ---------------------------------------------

    @cached_property
    def ep_duplicates(self) -> DataFrame:
        """Rows of known providers whose tax ID occurs more than once."""
        return self._routed({_KNOWN}, {_KNOWN}).where("_known_repeated").select(*_UNDATED)

    @cached_property
    def ep_unique(self) -> DataFrame:
        """Rows of known providers whose tax ID is not repeated, dated."""
        return self._routed({_KNOWN}, {_KNOWN}).where(self._pass("_known_repeated")).select(*LOOKUP_COLUMNS)

    def _conflicting(self) -> Column:
        """Existing rows under whose tax ID a single incoming row has another name, as written."""
        return self._of(_OLD) & F.coalesce(F.col(_NAME) != F.col(f"_single.{_NAME}"), F.lit(False))

    @cached_property
    def tin_conflict(self) -> DataFrame:
        """Tax IDs listed under another name: per pair the incoming and the existing row."""
        pairs = self._routed({_OLD}, {_OLD, _KNOWN}).where(self._conflicting())
        dated = {"formattedtin": format_tin("tin", self._tin_mode), "refresh_date": F.lit(self._now)}
        new = F.struct(*[dated.get(c, F.col(f"_single.{c}")).alias(c) for c in LOOKUP_COLUMNS])
        return pairs.select(F.inline(F.array(new, F.struct(*LOOKUP_COLUMNS))))

    def _known_accepted(self) -> Column:
        return self._of(_KNOWN) & self._pass("_known_repeated", "_known_conflict")

    @cached_property
    def ep_accepted(self) -> DataFrame:
        """Rows of known providers without a conflict."""
        return self._routed({_KNOWN}, {_OLD, _KNOWN}).where(self._known_accepted()).select(*LOOKUP_COLUMNS)

    # Tax IDs that are already known -------------------------------------------------

    @cached_property
    def tin_duplicates(self) -> DataFrame:
        """Known tax IDs that end up with several records, dated.

        These are rejected and merged as well; tax IDs with one record are
        neither. That is how the load is defined.
        """
        return self._routed({_SAME_TIN}, {_SAME_TIN}).where("_varies").select(*LOOKUP_COLUMNS)

    # New providers ------------------------------------------------------------------

    @cached_property
    def np_duplicates(self) -> DataFrame:
        """Rows of new providers whose tax ID occurs more than once."""
        return self._routed({_NEW}, {_NEW}).where("_new_repeated").select(*_FORMATTED)

    def _clashing(self) -> Column:
        """Existing rows, and single rows of new providers, that share a tax ID."""
        return F.coalesce(F.col("_new_single") & F.col("_taken"), F.lit(False))

    @cached_property
    def np_conflict(self) -> DataFrame:
        """Tax IDs of new providers that are already known: the existing rows and the new ones."""
        return self._routed({_OLD, _NEW}, {_OLD, _NEW}).where(self._clashing()).select(*LOOKUP_COLUMNS)

    def _new_accepted(self) -> Column:
        return self._of(_NEW) & self._pass("_new_repeated", "_new_taken")

    @cached_property
    def np_accepted(self) -> DataFrame:
        """Rows of new providers with unknown tax IDs, dated."""
        return self._routed({_NEW}, {_OLD, _NEW}).where(self._new_accepted()).select(*LOOKUP_COLUMNS)

    # Outputs --------------------------------------------------------------------------

    def _all(self, numbered: bool) -> DataFrame:
        kinds = {_OLD, _KNOWN, _NEW, _SAME_TIN}
        return self._routed(kinds, kinds, numbered)

    @cached_property
    def rejected(self) -> DataFrame:
        """All rejected rows with the reason, ordered by tax ID."""

        def entry(applies: Column, reason: str, of: str = "") -> Column:
            name = [F.col(of + c).alias(c) for c in ("tinname", _NAME)]
            return F.when(applies, F.struct("tin", *name, F.lit(reason).alias("RejectReason")))

        reasons = F.array(
            entry(self._of(_KNOWN) & F.col("_known_repeated"), SAME_PROVIDER),
            entry(self._of(_NEW) & F.col("_new_repeated"), SAME_PROVIDER),
            entry(self._of(_SAME_TIN) & F.col("_varies"), OTHER_PROVIDER),
            entry((self._of(_OLD) | self._of(_NEW)) & self._clashing(), OTHER_PROVIDER),
            entry(self._conflicting(), OTHER_PROVIDER, "_single."),
            entry(self._conflicting(), OTHER_PROVIDER),
        )
        # Rejects show no keys, so none are given out.
        return self._all(False).select(F.inline(F.array_compact(reasons))).orderBy("tin", "tinname", _NAME, "RejectReason")

    @cached_property
    def merged(self) -> DataFrame:
        """The new lookup table: latest record per tax ID and provider name as written."""
        taken_over = self._of(_SAME_TIN) & F.col("_varies")
        candidates = self._all(True).where(self._of(_OLD) | taken_over | self._known_accepted() | self._new_accepted())
        refreshed = F.try_to_timestamp("refresh_date", F.lit("yyyy-MM-dd HH:mm:ss"))
        return latest_per_key(
            candidates.select(*LOOKUP_COLUMNS), ["tin", _NAME], refreshed, tie_break=["tinname", "mpin", "health_system_id"]
        )


def reconcile_providers(
    existing: DataFrame, incoming: DataFrame, now: dt.datetime | str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The merged lookup, the rejected rows and the keyed rows of new providers."""
    load = Reconciliation(existing, incoming, now)
    return load.merged, load.rejected, load.new_provider
