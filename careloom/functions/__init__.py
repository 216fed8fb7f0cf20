"""Scalar functions, ``Column -> Column``, and the names table specs use for them."""

from careloom.functions import clinical, dates, numbers, text

BY_NAME = {
    f.__name__: f
    for f in (
        dates.format_date, dates.format_time, dates.date_of_datetime, dates.time_of_datetime,
        dates.time_by_position, dates.us_date, dates.date_or_default, dates.datetime_or_default, dates.first_date,
        numbers.to_double, numbers.keep_if_numeric, numbers.to_double_without_commas, numbers.leading_quantity,
        numbers.whole_or_decimal, numbers.strip_signs, numbers.ratio_text, numbers.non_ratio_number,
        text.null_word, text.after_pipe, text.first_eight, text.strip_exponent_marks, text.zip5, text.zip9,
        text.us_state, text.npi_flag, text.dash_join, text.without_controls,
        clinical.drg_version, clinical.drg_label, clinical.condition_status, clinical.lab_location,
        clinical.prn_flag, clinical.principal_diagnosis, clinical.present_on_admission,
        clinical.principal_procedure, clinical.discharge_disposition, clinical.result_qualifier,
        clinical.other_or_no_information,
    )
}
