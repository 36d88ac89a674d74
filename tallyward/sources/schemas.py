"""Column types of the clinic tables; money is in units of 1/10000 unless a report says otherwise."""

from __future__ import annotations

CHARGE_MEASURES = (
    "registered_fee",
    "medical_fee",
    "material_fee",
    "instrument_fee",
    "trad_medicine_fee",
    "decoction_fee",
    "west_medicine_fee",
    "cp_medicine_fee",
    "check_fee",
    "inspect_advice_fee",
    "other1_fee",
    "other2_fee",
    "other3_fee",
    "other4_fee",
    "exam_in_room",
    "exam_check",
    "exam_inspect",
    "other_fee",
    "diagnosis_fee",
    "receivable_amount",
)

SCHEMAS: dict[str, str] = {
    "ord_pay": (
        "pay_order_id bigint, order_id bigint, hospital_id bigint, doctor_name string, consultants_name string, "
        "buy_type int, state int, pay_type int, original_amount bigint, receivable_amount bigint, "
        "pay_amount bigint, deposit_amount bigint, medical_fund_payment bigint, "
        "create_date timestamp_ntz, registered_create_date timestamp_ntz"
    ),
    "ord_registered": (
        "registered_ord_id bigint, user_id bigint, hospital_id bigint, hospital_name string, depart_name string, "
        "doctor_name string, consultants_name string, registered_type int, state int, create_date timestamp_ntz"
    ),
    "ord_pay_classify": "pay_order_id bigint, " + ", ".join(f"{m} bigint" for m in CHARGE_MEASURES),
    "ord_fee_detail": (
        "pay_order_id bigint, hospital_id bigint, subject_type int, subject_id int, item_type int, "
        "pay_state int, total_price bigint, total_cost_price bigint"
    ),
    "ord_inquiry": (
        "inquiry_ord_id bigint, doctor_id string, user_id bigint, doctor_name string, buy_type int, "
        "ord_amount bigint, ord_state int, pay_state int, abnormal_state int, create_date timestamp_ntz"
    ),
    "ord_mobile_medical": (
        "inquiry_ord_id bigint, medical_ord_id bigint, doctor_id string, user_id bigint, user_name string, "
        "doctor_name string, total_price bigint, ord_state int, pay_state int, "
        "pay_date timestamp_ntz, create_date timestamp_ntz"
    ),
    "ord_mobile_prescription": (
        "doctor_id string, pay_state int, pay_type int, state int, create_date timestamp_ntz"
    ),
    "sec_hospital": "hospital_id bigint, hospital_name string",
    "sec_app_doctor": (
        "id string, name string, phone string, department string, medical_institution string, "
        "recommend_id int, binding_mechanism string"
    ),
    "sec_recommend": "recommend_id int, name string",
    "usr_user": "user_id bigint, user_name string, user_sex int, bill_id string",
    "usr_doctor_user_rel": (
        "doctor_id string, user_id bigint, brand_id bigint, state int, create_date timestamp_ntz"
    ),
    "usr_doctor_account_rel": "doctor_id string, account_id bigint, state int, create_date timestamp_ntz",
    "places": "`名称` string, `地址` string",
    "operations": "`诊所名称` string, `付款方式` string, `实收` decimal(18,2)",
}
