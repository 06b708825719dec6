"""Landing CSV format rules and golden rows."""

from carelake.sources.csv import list_landing, read_landing
from conftest import write_csv

PATIENT_HEADER = "PATIENT_ID,FULL_NAME,DOB,GENDER,PHONE,EMAIL,CITY,STATE,REGISTRATION_DATE"
BILLING_HEADER = ("BILL_ID,BILL_DATE,PATIENT_ID,SERVICE_CODE,SERVICE_DESC,DEPARTMENT,GROSS_AMOUNT,"
                  "DISCOUNT_AMOUNT,TAX_AMOUNT,NET_AMOUNT,PAYMENT_MODE,INSURER_NAME")


def test_null_tokens_trim_short_and_long_rows(spark, tmp_path):
    write_csv(tmp_path / "patients_a.csv", PATIENT_HEADER, [
        '1,  Ann  ,1990-01-01,N/A,NULL,None,"Pune, West",n/a,',
        "2,Bob,1990-01-01",                                     # short row -> NULLs
        "3,Cy,1990-01-01,Male,9999999999,c@x,City,State,2024-01-01,EXTRA,MORE",  # long row -> cut
        "   ,Dee,1990-01-01,,,,,,",                              # blank id -> NULL
    ])
    rows = {r.full_name: r for r in read_landing(spark, str(tmp_path), "patients").collect()}
    a = rows["Ann"]
    assert (a.patient_id, a.gender, a.phone, a.email, a.city, a.state, a.registration_date) == (
        "1", None, None, None, "Pune, West", None, None)
    assert rows["Bob"].gender is None and rows["Bob"].registration_date is None
    assert rows["Cy"].registration_date == "2024-01-01"
    assert rows["Dee"].patient_id is None
    assert all(r._source_file.endswith("patients_a.csv") and r._loaded_at is not None for r in rows.values())


def test_routing_by_file_name_and_gzip(spark, tmp_path):
    write_csv(tmp_path / "patients_1.csv", PATIENT_HEADER, ["1,A,1990-01-01,Male,9999999999,a@x,C,S,2024-01-01"])
    write_csv(tmp_path / "more_patients.csv.gz", PATIENT_HEADER,
              ["2,B,1990-01-01,Male,9999999999,b@x,C,S,2024-01-01"], gz=True)
    write_csv(tmp_path / "billing_1.csv", BILLING_HEADER,
              ["30218,2026-02-01,1005,OPD001,OPD Consultation,General Medicine,3464.5,370.59,173.23,4008.32,Cash,"])
    write_csv(tmp_path / "notes.txt", "x", ["y"])
    assert sorted(r.patient_id for r in read_landing(spark, str(tmp_path), "patients").collect()) == ["1", "2"]
    assert read_landing(spark, str(tmp_path), "billing").count() == 1
    assert read_landing(spark, str(tmp_path), "appointments").count() == 0
    names = sorted(r.path.rsplit("/", 1)[1] for r in list_landing(spark, str(tmp_path)).collect())
    assert names == ["billing_1.csv", "more_patients.csv.gz", "patients_1.csv"]


def test_golden_billing_rows(spark, tmp_path):
    """Rows copied from the shipped dirty billing file; expected from the rules."""
    from carelake.operators import clean as C

    write_csv(tmp_path / "billing_dirty.csv", BILLING_HEADER, [
        "30377,2026-02-02,1156,XR201,X-Ray,Orthopedics,-2946.78,126.08,147.34,-2673.36,Insurance,",
        "30017,2026-01-14,1010,US401,Ultrasound,Pediatrics,4074.64,581.88,203.73,3696.49,Insurance,ICICI Lombard",
        "30218,2026-02-01,1005,OPD001,OPD Consultation,General Medicine,3464.5,370.59,173.23,4008.32,Cash,",
        "30397,2026-01-31,1044,CT301,CT Scan,Neurology,3196.24,632.96,159.81,2723.09,Cheque,Star Health",
        "30067,2026-03-14,1145,LAB101,CBC Test,General Medicine,4702.43,132.27,235.12,5069.820000000001,Cash,",
    ])
    prepared = C.prepare("billing", read_landing(spark, str(tmp_path), "billing"))
    core = {r.bill_id: r for r in C.clean("billing", prepared).collect()}
    assert sorted(core) == [30017, 30067, 30218]
    # NET is recomputed: the source value (4008.32 for 30218) is ignored.
    assert str(core[30218].net_amount) == "3267.14"
    assert str(core[30067].net_amount) == "4805.28"
    assert core[30017].payment_mode == "INSURANCE"
    reasons = {r._raw_id: r._reasons for r in C.rejects("billing", prepared).collect()}
    assert reasons["30377"] == ["NEGATIVE_GROSS_AMOUNT", "NEGATIVE_NET_AMOUNT", "MISSING_INSURER"]
    assert reasons["30397"] == ["INVALID_PAYMENT_MODE"]


def test_golden_patient_rows(spark, tmp_path):
    from carelake.operators import clean as C

    write_csv(tmp_path / "patients_master_dirty.csv", PATIENT_HEADER, [
        "1059,Priya Mehta,31/02/1995,Male,12345,priya.mehta[at]example.com,Pune,Maharashtra,2024-11-05",
        "1041,Pari Gupta,1981-04-15,Female,9297018781,pari.gupta@example.com,Pune,Maharashtra,2024-08-24",
    ])
    prepared = C.prepare("patients", read_landing(spark, str(tmp_path), "patients"))
    assert [r.patient_id for r in C.clean("patients", prepared).collect()] == [1041]
    (bad,) = C.rejects("patients", prepared).collect()
    assert bad._reasons == ["INVALID_DOB", "INVALID_EMAIL", "INVALID_PHONE"]
