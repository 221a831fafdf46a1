"""Fixed dimension tables. All are constants of the domain, at most 41 rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Letter codes and their descriptions.
LETTER_CODES = {
    "ن-10": "صورت های مالی میان دوره ای",
    "ن-11": "گزارش فعالیت هیئت مدیره",
    "ن-12": "گزارش کنترل داخلی",
    "ن-13": "زمان بندی پرداخت سود",
    "ن-20": "افشای اطلاعات با اهمیت",
    "ن-21": "شفاف سازی در خصوص شایعه، خبر یا گزارش منتشر شده",
    "ن-22": "شفاف سازی در خصوص نوسان قیمت سهام",
    "ن-23": "اطلاعات حاصل از برگزاری کنفرانس اطلاع رسانی",
    "ن-24": "درخواست ارایه مهلت جهت رعایت ماده ۱۹ مکرر ۱/ ۱۲ مکرر ۴ دستورالعمل اجرایی",
    "ن-25": "برنامه ناشر جهت خروج از شمول ماده ۱۴۱ لایحه قانونی اصلاح قسمتی از قانون تجارت",
    "ن-26": "توضیحات در خصوص اطلاعات و صورت های مالی منتشر شده",
    "ن-30": "گزارش فعالیت ماهانه",
    "ن-41": "مشخصات کمیته حسابرسی و واحد حسابرسی داخلی",
    "ن-42": "آگهی ثبت تصمیمات مجمع عادی سالیانه",
    "ن-43": "اساسنامه شرکت مصوب مجمع عمومی فوق العاده",
    "ن-45": "معرفی/تغییر در ترکیب اعضای هیئت‌مدیره",
    "ن-50": "آگهی دعوت به مجمع عمومی عادی سالیانه",
    "ن-51": "خلاصه تصمیمات مجمع عمومی عادی سالیانه",
    "ن-52": "تصمیمات مجمع عمومی عادی سالیانه",
    "ن-53": "آگهی دعوت به مجمع عمومی عادی سالیانه نوبت دوم",
    "ن-54": "آگهی دعوت به مجمع عمومی عادی بطور فوق العاده",
    "ن-55": "تصمیمات مجمع عمومی عادی بطور فوق العاده",
    "ن-56": "آگهی دعوت به مجمع عمومی فوق العاده",
    "ن-57": "تصمیمات مجمع عمومی فوق‌العاده",
    "ن-58": "لغو آگهی (اطلاعیه) دعوت به مجمع عمومی",
    "ن-59": "مجوز بانک مرکزی جهت برگزرای مجمع عمومی عادی سالیانه",
    "ن-60": "پیشنهاد هیئت مدیره به مجمع عمومی فوق العاده در خصوص افزایش سرمایه",
    "ن-61": "اظهارنظر حسابرس و بازرس قانونی نسبت به گزارش توجیهی هیئت مدیره",
    "ن-62": "مدارک و مستندات درخواست افزایش سرمایه",
    "ن-63": "تمدید مهلت استفاده از مجوز افزایش سرمایه",
    "ن-64": "مهلت استفاده از حق تقدم خرید سهام",
    "ن-65": "اعلامیه پذیره نویسی عمومی",
    "ن-66": "نتایج حاصل از فروش حق تقدم های استفاده نشده",
    "ن-67": "آگهی ثبت افزایش سرمایه",
    "ن-69": "توزیع گواهی نامه نقل و انتقال و سپرده سهام",
    "ن-70": "تصمیم هیئت مدیره به انجام افزایش سرمایه تفویض شده",
    "ن-71": "زمان تشکیل جلسه هیئت‌مدیره در خصوص افزایش سرمایه",
    "ن-72": "لغو اطلاعیه زمان تشکیل جلسه هیئت مدیره در خصوص افزایش سرمایه",
    "ن-73": "تصمیمات هیئت‌مدیره در خصوص افزایش سرمایه",
    "ن-80": "تغییر نشانی",
    "ن-81": "درخواست تکمیل مشخصات سهامداران",
}

# Company types and their aliases.
COMPANY_TYPES = {
    "بورس": "1",
    "فرابورس": "2",
    "پایه": "3",
    "all": "-1",
    "همه": "-1",
    "bourse": "1",
    "farabourse": "2",
    "otc": "3",
}

# Names that mean "every period length".
ANY_PERIOD = (None, -1, 0, "همه موارد", "all")

# Codes behind the canned searches.
BOARD_CHANGE = "ن-45"
FINANCIAL_STATEMENT = "ن-10"
MONTHLY_REPORT = "ن-30"

# Value domains of the data-quality rules.
COMPANY_TYPE_DOMAIN = ("1", "2", "3", "-1")
AUDIT_STATUS_DOMAIN = ("audited", "not_audited", "both")
ERROR_TYPE_DOMAIN = (
    "timeout",
    "navigation",
    "selector_not_found",
    "parsing",
    "network",
    "authentication",
    "rate_limit",
    "unknown",
)
EXPORT_FORMAT_DOMAIN = ("csv", "xlsx", "json", "parquet")


def letter_codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(LETTER_CODES.items()), "letter_code string, letter_description string"
    )


def company_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(COMPANY_TYPES.items()), "alias string, company_type string")


def period_length(value: int | str | None) -> int | None:
    """Months 1-12 in any digit script; anything else means unset."""
    if value in ANY_PERIOD:
        return None
    text = str(value)
    # int() reads Persian and Arabic digits as well as ASCII ones.
    months = int(text) if text.isdecimal() else 0
    return months if 1 <= months <= 12 else None
