"""Invented clinic tables holding the edge rows."""

from datetime import datetime

from tallyward.sources.schemas import CHARGE_MEASURES, SCHEMAS


def at(text):
    return datetime.fromisoformat(text)


def frame(spark, table, rows):
    """Rows as dictionaries; columns left out are null."""
    schema = spark.createDataFrame([], SCHEMAS[table]).schema
    return spark.createDataFrame([tuple(row.get(c) for c in schema.names) for row in rows], schema)


def visit(number, clinic="North", doctor="Ada", depart="Eyes", **more):
    return {
        "registered_ord_id": number,
        "user_id": number,
        "hospital_id": 1,
        "hospital_name": clinic,
        "depart_name": depart,
        "doctor_name": doctor,
        "consultants_name": "Cy",
        "registered_type": 1,
        "state": 5,
        "create_date": at("2021-03-05 10:00:00"),
        **more,
    }


def payment(number, order, units, method=1, day="2021-03-05 10:00:00", **more):
    return {
        "pay_order_id": number,
        "order_id": order,
        "hospital_id": 1,
        "doctor_name": "Ada",
        "consultants_name": "Cy",
        "buy_type": 1,
        "state": 1,
        "pay_type": method,
        "original_amount": units,
        "receivable_amount": units,
        "pay_amount": units,
        "deposit_amount": units,
        "medical_fund_payment": units,
        "create_date": at(day),
        "registered_create_date": at(day),
        **more,
    }


def charges(number, units):
    return {"pay_order_id": number, **{m: units for m in CHARGE_MEASURES}}


def fee(number, codes, price, cost, **more):
    subject_type, subject_id, item_type = codes
    return {
        "pay_order_id": number,
        "hospital_id": 1,
        "subject_type": subject_type,
        "subject_id": subject_id,
        "item_type": item_type,
        "pay_state": 2,
        "total_price": price,
        "total_cost_price": cost,
        **more,
    }


def doctor(number, name, institution="100", **more):
    return {
        "id": number,
        "name": name,
        "phone": f"phone {name}",
        "department": "Eyes",
        "medical_institution": "Main",
        "recommend_id": 1,
        "binding_mechanism": institution,
        **more,
    }


def user(number, sex=1):
    return {"user_id": number, "user_name": f"patient {number}", "user_sex": sex, "bill_id": f"phone {number}"}


def registration(doctor_id, user_id, moment, **more):
    return {"doctor_id": doctor_id, "user_id": user_id, "brand_id": 7, "state": 1, "create_date": at(moment), **more}
