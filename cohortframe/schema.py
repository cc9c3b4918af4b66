"""Column roles.

Operators never hard-code column names: they take a :class:`Columns` map of
role -> column name.  Every feature operator emits only the features whose
inputs exist in the frame (optional-column contract), so the same code runs on
the full survey table, a cohort subset with columns dropped, or a test table
without the label.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Columns:
    id: str = "id"
    name: str = "name"
    gender: str = "gender"
    age: str = "age"
    city: str = "city"
    cohort: str = "cohort"
    profession: str = "profession"
    academic_pressure: str = "academic_pressure"
    work_pressure: str = "work_pressure"
    cgpa: str = "cgpa"
    study_satisfaction: str = "study_satisfaction"
    job_satisfaction: str = "job_satisfaction"
    sleep: str = "sleep_duration"
    diet: str = "dietary_habits"
    degree: str = "degree"
    suicidal: str = "suicidal"
    hours: str = "hours"
    financial_stress: str = "financial_stress"
    family_history: str = "family_history"
    label: str = "label"
    # values of the cohort column
    student: str = "Student"
    professional: str = "Working Professional"
    # columns removed before modelling when no explicit list is given
    default_drop: tuple = field(default=("name", "city", "degree"))

    def with_(self, **kw) -> "Columns":
        return replace(self, **kw)

    # -- groups used by several stages -------------------------------------
    @property
    def student_only(self) -> tuple:
        """Columns that only students have (structural NULL for professionals)."""
        return (self.academic_pressure, self.study_satisfaction, self.cgpa)

    @property
    def professional_only(self) -> tuple:
        """Columns that only professionals have (structural NULL for students)."""
        return (self.work_pressure, self.job_satisfaction)

    @property
    def cohort_numeric(self) -> tuple:
        return self.student_only + self.professional_only

    @property
    def core(self) -> tuple:
        """Columns every row is expected to carry."""
        return (self.gender, self.age, self.sleep, self.diet, self.suicidal,
                self.hours, self.financial_stress, self.family_history)

    @property
    def numeric_profile(self) -> tuple:
        """Numeric columns compared between target classes."""
        return (self.age, self.academic_pressure, self.work_pressure, self.cgpa,
                self.study_satisfaction, self.job_satisfaction, self.hours,
                self.financial_stress)


DEFAULT_COLUMNS = Columns()
