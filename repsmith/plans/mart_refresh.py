"""All marts as stored tables, refreshed along their dependencies.

A set of changed workouts travels from table to table, with each table's own key:

    fct_set, fct_workout, sessions    the changed workouts
    fct_exercise_session              those; the sessions on an exercise's days whose trailing best came out
                                      different; and the workouts that are or were the first of a day (of an
                                      exercise's day) and take its gap, where that came out different
    obt_sets                          the changed workouts, and the workouts whose session row came out different

What a session row takes from other rows stands in two tables bounded by the calendar, per exercise and
day and per day: they are made before and after the change, and where they differ is what moved.

Every table is a ``KeyedTable`` by workout to which increments are appended, so a refresh writes what
changed; the day tables read some columns of the sessions of the touched exercises and of all live
workouts. What a step needs to know of the old state is written down before the first table changes, so a
refresh that stopped halfway is run again under its number with the same result; one that ended is not run
twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repsmith.operators.incremental import BROADCAST_KEYS, BatchLedger, KeyedTable
from repsmith.operators.joins import broadcast_if_bounded, join_null_safe
from repsmith.plans import marts as M
from repsmith.session import path_exists, remove_tree, staged

DAY, EXERCISE = "workout_date_local", "canonical_exercise"
#: Up to this many rows the day table of all sessions goes to every task.
BROADCAST_DAYS = 600_000
#: What a refresh writes down until it has ended.
PENDING = ("exercises", "old-workouts", "old-sessions", "new-workouts", "new-sessions", "wide")


class StoredMarts:
    """The marts under one folder. ``entity_cols`` as in ``build_marts``."""

    def __init__(self, spark: SparkSession, base: str, entity_cols: Sequence[str] = (), n_buckets: int = 64):
        self.spark, self.base, self.entity = spark, base.rstrip("/"), list(entity_cols)
        table = lambda name: KeyedTable(spark, f"{self.base}/{name}", "workout_id", n_buckets, deltas=True)
        self.by_exercise = [*self.entity, EXERCISE]
        self.fct_set, self.fct_workout, self.obt_sets = table("fct_set"), table("fct_workout"), table("obt_sets")
        self.sessions, self.fct_exercise_session = table("sessions"), table("fct_exercise_session")
        self.done = BatchLedger(spark, f"{self.base}/refreshes", "marts")

    def build(self, workouts: DataFrame, sets: DataFrame, dim: DataFrame, derive: Callable[..., DataFrame] | None = None) -> None:
        """All tables anew, each from those before it; ``derive`` as in ``marts.fct_set``. The set fact is kept on
        the executors' disks meanwhile, dealt by workout: its rollups and the wide table need it so."""
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        facts = M.fct_set(sets, workouts, dim, self.entity, derive).repartition(tasks, "workout_id").persist(StorageLevel.DISK_ONLY)
        try:
            self.fct_set.overwrite(facts)
            self.fct_workout.overwrite(M.fct_workout(workouts, facts, self.entity))
            self.sessions.overwrite(M.exercise_sessions(facts, self.entity))
            live, sessions = self.fct_workout.read(), self.sessions.read()
            if self.entity:
                self.fct_exercise_session.overwrite(M.fct_exercise_session(sessions, live, self.entity))
            else:  # the day tables are bounded by the exercises and the calendar
                with staged(M.session_days(sessions), "days") as days:
                    self.fct_exercise_session.overwrite(M.session_facts_at(sessions, M.workout_days(live), broadcast_if_bounded(days, BROADCAST_DAYS)))
            self.obt_sets.overwrite(M.obt_sets(facts, live, self.fct_exercise_session.read(), self.entity))
        finally:
            facts.unpersist()

    def _own(self, table: KeyedTable, ids: DataFrame) -> DataFrame:
        """The rows of the workouts ``ids`` (a written table), read from their buckets."""
        return join_null_safe(table.read_buckets(table.buckets(ids)), broadcast_if_bounded(ids, BROADCAST_KEYS), table.keys, "left_semi")

    def _kept(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` as it was when the step was first reached, also when a stopped refresh is run again."""
        path = f"{self.base}/pending/{name}"
        if not path_exists(self.spark, f"{path}/_SUCCESS"):
            df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def refresh(self, workouts: DataFrame, sets: DataFrame, dim: DataFrame, changed: DataFrame, refresh_id: int) -> bool:
        """Bring the tables to the state of ``workouts`` and ``sets`` (the staging frames as they are now), of
        which the workouts ``changed`` (workout_id) were added, edited or deleted. False where done before."""
        if self.done.applied(refresh_id):
            return False
        with staged(changed.select("workout_id").distinct(), "changed") as ids:
            few = broadcast_if_bounded(ids, BROADCAST_KEYS)
            own = lambda df: join_null_safe(df, few, ["workout_id"], "left_semi")
            with staged(M.fct_set(own(sets), own(workouts), dim, self.entity), "sets") as rows:
                now = M.exercise_sessions(rows, self.entity)
                touched = self._own(self.sessions, ids).select(*self.by_exercise).unionByName(now.select(*self.by_exercise))
                exercises = self._kept(f"{refresh_id}-exercises", touched.distinct())
                old = self._days(refresh_id, "old", exercises)
                self.fct_set.replace_keys(rows, ids)
                self.fct_workout.replace_keys(M.fct_workout(own(workouts), own(sets), self.entity), ids)
                self.sessions.replace_keys(now, ids)
            new = self._days(refresh_id, "new", exercises)
            with staged(self._moved(old, new).unionByName(ids).distinct(), "moved") as moved:
                mine = self._own(self.sessions, moved)
                # Exercises that did not move are met again in workouts that did.
                others = join_null_safe(mine.select(*self.by_exercise).distinct(), exercises, self.by_exercise, "left_anti")
                with staged(others, "others") as others, staged(M.session_facts_at(mine, new[0], new[1].unionByName(self._session_days(others)), self.entity), "sessions") as fresh:
                    stored = self._own(self.fct_exercise_session, moved).select(*fresh.columns)
                    different = fresh.exceptAll(stored).unionByName(stored.exceptAll(fresh)).select("workout_id")
                    wide = self._kept(f"{refresh_id}-wide", different.unionByName(ids).distinct())
                    self.fct_exercise_session.replace_keys(join_null_safe(fresh, broadcast_if_bounded(wide, BROADCAST_KEYS), ["workout_id"], "left_semi"), wide)
            self.obt_sets.replace_keys(M.obt_sets(*[self._own(t, wide) for t in (self.fct_set, self.fct_workout, self.fct_exercise_session)], self.entity), wide)
        self.done.add(refresh_id)
        for name in PENDING:
            remove_tree(self.spark, f"{self.base}/pending/{refresh_id}-{name}")
        return True

    def _days(self, refresh_id: int, name: str, exercises: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The day tables as they are now: of all live workouts, and of the sessions of ``exercises``."""
        live = self.fct_workout.read().select("workout_id", *self.entity, DAY)
        return (self._kept(f"{refresh_id}-{name}-workouts", M.workout_days(live, self.entity)),
                self._kept(f"{refresh_id}-{name}-sessions", self._session_days(exercises)))

    def _session_days(self, exercises: DataFrame) -> DataFrame:
        """The day table of the sessions of ``exercises`` (a written table)."""
        few = broadcast_if_bounded(exercises, BROADCAST_KEYS)
        return M.session_days(join_null_safe(self.sessions.read(), few, self.by_exercise, "left_semi"), self.entity)

    def _moved(self, old: tuple[DataFrame, DataFrame], new: tuple[DataFrame, DataFrame]) -> DataFrame:
        """The workouts whose session rows may come out different as the day tables do (workout_id)."""
        firsts = None
        for was, now, keys in zip(old, new, ([*self.entity, DAY], [*self.by_exercise, DAY])):
            columns = [*keys, "__first_id", "__prev"]
            was, now = was.select(*columns), now.select(*columns)
            differ = now.subtract(was).unionByName(was.subtract(now)).select(F.col("__first_id").alias("workout_id"))
            firsts = differ if firsts is None else firsts.unionByName(differ)
        columns = [*self.by_exercise, DAY, *M.TRAILING.values()]
        best = new[1].select(*columns).subtract(old[1].select(*columns)).select(*self.by_exercise, DAY)
        with_best = join_null_safe(self.sessions.read(), broadcast_if_bounded(best, BROADCAST_KEYS), [*self.by_exercise, DAY], "left_semi")
        return firsts.unionByName(with_best.select("workout_id"))
