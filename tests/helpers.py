"""Paths, rows and small helpers that the test modules share."""

from datetime import datetime

SMALL = "/root/testdata/sf0.001"


def at(text):
    return datetime.fromisoformat(text)


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


PEOPLE = [
    # id, cpf, name, mail, phone, age, sex, city, state, pressure, rate, temp, o2, diagnosis, drug, time
    ("PAC-100001", "123.456.789-09", "Ana Souza", "Ana@mail.example", "(11) 91234-5678", 40, "F", "Recife", "PE",
     "130/85", 78, 36.5, 98, "Hipertensão", "Losartana", "2024-01-15 10:30:00"),
    ("PAC-100002", "987.654.321-00", "Bruno Lima", "bruno@mail.example", "(21) 99876-4321", 61, "M", "Niterói", "RJ",
     "160/100", 92, 37.2, 95, "Diabetes Tipo 2", "Metformina", "2024-01-15 11:00:00"),
    ("PAC-100003", "111.222.333-96", "Carla Dias", "carla@mail.example", "(31) 90000-0003", 35, "F", "Betim", "MG",
     "120/80", 70, 38.5, 97, "COVID-19", "Dipirona", "2024-01-15 11:30:00"),
    ("PAC-100004", "444.555.666-77", "Davi Reis", "davi@mail.example", "(41) 90000-0004", 23, "M", "Londrina", "PR",
     "85/55", 55, 36.8, 99, "Check-up Rotina", None, "2024-01-15 12:00:00"),
]
