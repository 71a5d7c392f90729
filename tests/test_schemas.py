"""Names, order and types of the marts' columns."""

import fixtures as fx
import pytest

MARTS = {
    "dim_customer": (
        "customer_id bigint, first_name string, last_name string, full_name string, email string, "
        "is_active boolean, create_date date, store_id bigint, address_line1 string, "
        "address_line2 string, district string, postal_code string, phone string, "
        "city_name string, country_name string, customer_location string, "
        "customer_last_update timestamp_ntz"
    ),
    "dim_film": (
        "film_id bigint, title string, description string, release_year int, language_id bigint, "
        "rental_duration smallint, rental_rate decimal(4,2), length_minutes smallint, "
        "replacement_cost decimal(5,2), rating string, category_name string, "
        "film_length_category string, rental_rate_category string, "
        "film_last_update timestamp_ntz"
    ),
    "dim_store": (
        "store_id bigint, manager_staff_id bigint, address_line1 string, address_line2 string, "
        "district string, postal_code string, phone string, city_name string, "
        "country_name string, store_location string, store_last_update timestamp_ntz"
    ),
    "dim_date": (
        "date_day date, year int, month int, day int, quarter int, day_of_week int, "
        "day_of_year int, week_of_year int, year_month string, year_quarter string, "
        "day_name string, month_name string, is_weekend boolean, is_weekday boolean, "
        "is_month_start boolean, is_month_end boolean"
    ),
    "fct_rental": (
        "rental_id bigint, customer_id bigint, film_id bigint, store_id bigint, "
        "staff_id bigint, rental_date_id date, return_date_id date, payment_date_id date, "
        "rental_date timestamp_ntz, return_date timestamp_ntz, payment_date timestamp_ntz, "
        "inventory_id bigint, payment_id bigint, payment_amount decimal(12,2), "
        "expected_amount decimal(12,2), rental_duration_days bigint, "
        "expected_rental_duration smallint, actual_payment decimal(12,2), "
        "payment_variance decimal(12,2), is_not_returned boolean, is_late_return boolean, "
        "days_overdue bigint, calculated_late_fee decimal(12,2), "
        "rental_last_update timestamp_ntz"
    ),
    "rental_analytics": (
        "rental_id bigint, payment_id bigint, inventory_id bigint, customer_id bigint, customer_name string, "
        "customer_first_name string, customer_last_name string, customer_email string, "
        "is_active_customer boolean, customer_location string, customer_city string, "
        "customer_country string, customer_postal_code string, customer_phone string, "
        "film_id bigint, film_title string, film_description string, release_year int, "
        "film_rating string, film_category string, film_length_minutes smallint, "
        "film_length_category string, film_rental_rate decimal(4,2), "
        "rental_rate_category string, film_replacement_cost decimal(5,2), store_id bigint, "
        "store_location string, store_city string, store_country string, rental_date date, "
        "rental_year int, rental_month int, rental_quarter int, rental_day_name string, "
        "rental_month_name string, is_rental_weekend boolean, is_rental_weekday boolean, "
        "return_date timestamp_ntz, payment_date timestamp_ntz, payment_amount decimal(12,2), "
        "expected_amount decimal(12,2), actual_payment decimal(12,2), "
        "payment_variance decimal(12,2), actual_rental_days bigint, "
        "expected_rental_days smallint, days_overdue bigint, calculated_late_fee decimal(12,2), "
        "is_not_returned boolean, is_late_return boolean, return_status string, "
        "payment_status string, total_revenue decimal(12,2), is_profitable_rental boolean, "
        "rental_count int, rental_last_update timestamp_ntz"
    ),
}


@pytest.fixture(scope="module")
def models(spark):
    return fx.models(spark)


@pytest.mark.parametrize("name", MARTS)
def test_columns(models, name):
    assert ", ".join(map(" ".join, models[name].dtypes)) == MARTS[name]
