"""Small generated training-log documents covering the cases listed in FIXTURES.md."""

import json


def _set(i, typ, kg, reps, rpe=None):
    return {"index": i, "type": typ, "weight_kg": kg, "reps": reps, "rpe": rpe,
            "duration_seconds": None, "distance_meters": None, "custom_metric": None}


def workout(wid, start, end, exercises, updated=None, title="W"):
    return {"id": wid, "title": title, "description": None, "routine_id": None,
            "start_time": start, "end_time": end, "created_at": start, "updated_at": updated or end,
            "exercises": exercises}


def exercise(i, tid, sets, superset=None, notes=None, title="E"):
    return {"index": i, "title": title, "exercise_template_id": tid, "superset_id": superset,
            "notes": notes, "sets": sets}


LB = 2.20462

WORKOUTS_V1 = [
    # evening Eastern session that crosses the UTC date; lb-native noise weight
    workout("w1", "2024-03-01T23:30:00+00:00", "2024-03-02T00:45:30+00:00", [
        exercise(0, "t-bench", [_set(0, "warmup", 20, 10), _set(1, "normal", 90 / LB, 5, 8.5),
                                _set(2, "failure", 90 / LB, 6), _set(3, "dropset", 60 / LB, 12)],
                 notes="   "),
        exercise(1, "t-squat", [_set(0, "normal", 100, 13), _set(1, "normal", 100, 0),
                                _set(2, "normal", None, 5)], superset=1),
    ]),
    # same-day double session, kg-native, a half-step rounding tie
    workout("w2", "2024-03-02T12:00:00+00:00", "2024-03-02T12:40:00+00:00", [
        exercise(0, "t-bench", [_set(0, "normal", 1.005, 12), _set(1, "normal", 40, 1)]),
    ]),
    workout("w3", "2024-03-02T15:00:00+00:00", "2024-03-02T15:20:00+00:00", [
        exercise(0, "t-bench", [_set(0, "normal", 41, 3)]),
        exercise(1, "t-unmapped", [_set(0, "normal", 10, 10)]),
    ]),
    # gaps of 89, 90, 91 days after w1's local date (2024-03-01)
    workout("w4", "2024-05-29T16:00:00+00:00", "2024-05-29T17:00:00+00:00", [
        exercise(0, "t-bench", [_set(0, "normal", 45, 5)])]),
    workout("w5", "2024-05-30T16:00:00+00:00", "2024-05-30T17:00:00+00:00", [
        exercise(0, "t-bench", [_set(0, "normal", 30, 5)])]),
    workout("w6", "2024-05-31T16:00:00+00:00", "2024-05-31T17:00:00+00:00", [
        exercise(0, "t-bench", [_set(0, "dropset", 50, 5)])]),
    # null and empty exercise lists
    workout("w7", "2024-06-01T16:00:00+00:00", "2024-06-01T16:30:00+00:00", None),
    workout("w8", "2024-06-02T16:00:00+00:00", "2024-06-02T16:30:00+00:00", []),
    # before the first era, and across both DST transitions
    workout("w9", "2023-11-05T06:30:00+00:00", "2023-11-05T07:10:00+00:00", [
        exercise(0, "t-squat", [_set(0, "normal", 80, 5)])]),
    workout("w10", "2024-03-10T07:30:00+00:00", "2024-03-10T08:00:00+00:00", [
        exercise(0, "t-squat", [_set(0, "normal", 85, 5)])]),
]

TEMPLATES = [
    {"id": "t-bench", "title": "Bench Press", "type": "weight_reps", "primary_muscle_group": "chest",
     "secondary_muscle_groups": ["triceps", "shoulders"], "equipment": "barbell", "is_custom": False},
    {"id": "t-squat", "title": "Squat", "type": "weight_reps", "primary_muscle_group": "quads",
     "secondary_muscle_groups": [], "equipment": "barbell", "is_custom": False},
    {"id": "t-pull", "title": "Pull Up", "type": "bodyweight_weighted", "primary_muscle_group": "lats",
     "secondary_muscle_groups": ["biceps"], "equipment": "none", "is_custom": False},
    {"id": "t-unmapped", "title": "Odd", "type": None, "primary_muscle_group": None,
     "secondary_muscle_groups": None, "equipment": None, "is_custom": True},
]

CROSSWALK = [("t-bench", "Bench Press", "bench_press", "horizontal_push", False, True),
             ("t-squat", "Squat", "squat", "squat", False, True),
             ("t-pull", "Pull Up", "pull_up", "vertical_pull", False, True)]

ERAS = [("early", "2024-01-01", "2024-04-30", "first"), ("late", "2024-05-01", "9999-12-31", "second")]


def dumps(objs):
    return [(json.dumps(o),) for o in objs]
