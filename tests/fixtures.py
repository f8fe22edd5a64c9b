"""Small hand-written IVR fixtures covering the edge cases of the source model:
labels with ATC/TECH prefixes, exact ABSORPTION, mixed case, NULL and other;
module AVERIA_MASIVA; info steps with OK and not OK; a call without modules;
a module without steps; a step without a module; calls with two documents and
two accounts; a flagged phone step without a phone; gaps of 23:59:59 and
exactly 24:00:00; equal start times on one phone; NULL and 'UNKNOWN' phones;
call ids 0.0 and -0.0."""

from datetime import datetime

from dialtone.sources.ivr_schema import CALLS_SCHEMA, MODULES_SCHEMA, STEPS_SCHEMA

T0 = datetime(2024, 1, 1, 8, 0, 0)


def ts(h=0, m=0, s=0, day=1):
    return datetime(2024, 1, day, h, m, s)


def calls_rows():
    # ivr_id, phone, result, label, start, end, duration, segment, lang, steps_module, module_agg
    def c(i, phone, label, start):
        return (i, phone, "OK", label, start, start, 60, "RES", "ES", 1, "AGG")
    return [
        c(1.0, "600", "ATC_web", ts(8)),
        c(2.0, "600", "tech_l2", ts(8, 30)),           # same phone, 30 min later
        c(3.0, "600", "ABSORPTION", ts(8, 30, 0, day=2)),   # exactly 24:00:00 after call 2
        c(4.0, "700", "absorption", ts(10)),
        c(5.0, "700", "Absorption2", ts(9, 59, 59, day=2)),  # 23:59:59 after call 4
        c(6.0, "700", None, ts(9, 59, 59, day=2)),     # tie with call 5
        c(7.0, None, "other", ts(12)),                 # NULL phone
        c(8.0, None, "ATC", ts(13)),
        c(9.0, "UNKNOWN", "TECHNICAL", ts(14)),
        c(10.0, "UNKNOWN", "x", ts(15, day=3)),
        c(0.0, "800", "atc", ts(16)),
        c(11.0, "900", "TECH", None),                  # NULL start
        c(12.0, "900", "TECH", ts(1)),
    ]


def modules_rows():
    # ivr_id, seq, name, duration, result
    return [
        (1.0, 1, "AVERIA_MASIVA", 10, "OK"),
        (1.0, 2, "OTHER", 10, "OK"),
        (2.0, 1, "OTHER", 10, "KO"),
        (3.0, 1, "OTHER", 10, "OK"),                 # module without steps
        (4.0, 1, "AVERIA_MASIVA", 10, "OK"),
        (5.0, 1, "OTHER", 10, "OK"),
        (6.0, 1, "OTHER", 10, "OK"),
        (7.0, 1, "OTHER", 10, "OK"),
        (9.0, 1, "OTHER", 10, "OK"),
        (-0.0, 1, "OTHER", 10, "OK"),                # matches call 0.0
        (12.0, 1, "OTHER", 10, "OK"),
        # call 8, 10, 11 have no module
    ]


def steps_rows():
    # ivr_id, seq, step_seq, name, result, error, doc_type, doc_id, phone, bill
    def s(i, seq, n, name, res, dt="UNKNOWN", di="UNKNOWN", ph="UNKNOWN", bill="UNKNOWN"):
        return (i, seq, n, name, res, None, dt, di, ph, bill)
    return [
        s(1.0, 1, 1, "CUSTOMERINFOBYPHONE.TX", "OK", ph="600"),
        s(1.0, 1, 2, "CUSTOMERINFOBYDNI.TX", "OK", dt="DNI", di="111A", bill="B1"),
        s(1.0, 2, 1, "X", "OK", dt="DNI", di="222B", bill="B2"),     # two documents, two bills
        s(1.0, 2, 2, "X", "OK", dt="DNI", di="111A", bill="B1"),     # repeats
        s(2.0, 1, 1, "CUSTOMERINFOBYPHONE.TX", "OK"),                # flagged, no phone
        s(2.0, 1, 2, "CUSTOMERINFOBYDNI.TX", "KO", dt="NIE", di="X9"),
        s(4.0, 1, 1, "CUSTOMERINFOBYPHONE.TX", "KO", ph="700"),
        s(4.0, 1, 2, "X", "OK", ph="701"),                           # two phones in a call
        s(5.0, 1, 1, "CUSTOMERINFOBYDNI.TX", "OK", dt=None, di="5", bill=None),
        s(6.0, 1, 1, "X", None, dt="DNI", di=None),
        s(7.0, 1, 1, "X", "OK", dt="A-B", di="C", bill="B7"),        # concat collision
        s(7.0, 1, 2, "X", "OK", dt="A", di="B-C", bill="B7"),
        s(9.0, 1, 1, "X", "OK", bill="B9"),
        s(0.0, 1, 1, "X", "OK", ph="800"),                           # -0.0 module joins 0.0 step
        s(13.0, 1, 1, "X", "OK", ph="999"),                          # step without module: lost
        s(12.0, 1, 1, "CUSTOMERINFOBYPHONE.TX", "OK", ph="900"),
    ]


def ivr_frames(spark):
    return (spark.createDataFrame(calls_rows(), CALLS_SCHEMA),
            spark.createDataFrame(modules_rows(), MODULES_SCHEMA),
            spark.createDataFrame(steps_rows(), STEPS_SCHEMA))
