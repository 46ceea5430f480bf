"""Schemas and column lists of the catalogues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def flat_schema(text: str) -> T.StructType:
    """Schema from ``name type, name type``; unlike ``fromDDL`` it needs no session."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (f.split() for f in text.split(","))])


# The bronze schema of star tables, in file order.
STAR_BRONZE_DDL = """
solution_id bigint, designation string, source_id bigint, random_index bigint, ref_epoch bigint,
ra double, ra_error double, dec double, dec_error double, parallax double, parallax_error double,
parallax_over_error double, pm double, pmra double, pmra_error double, pmdec double, pmdec_error double,
ra_dec_corr double, ra_parallax_corr double, ra_pmra_corr double, ra_pmdec_corr double,
dec_parallax_corr double, dec_pmra_corr double, dec_pmdec_corr double, parallax_pmra_corr double,
parallax_pmdec_corr double, pmra_pmdec_corr double, astrometric_n_obs_al bigint,
astrometric_n_obs_ac bigint, astrometric_n_good_obs_al bigint, astrometric_n_bad_obs_al bigint,
astrometric_gof_al double, astrometric_chi2_al double, astrometric_excess_noise double,
astrometric_excess_noise_sig double, astrometric_params_solved bigint, astrometric_primary_flag boolean,
nu_eff_used_in_astrometry string, pseudocolour double, pseudocolour_error double,
ra_pseudocolour_corr double, dec_pseudocolour_corr double, parallax_pseudocolour_corr double,
pmra_pseudocolour_corr double, pmdec_pseudocolour_corr double, astrometric_matched_transits bigint,
visibility_periods_used bigint, astrometric_sigma5d_max double, matched_transits bigint,
new_matched_transits bigint, matched_transits_removed bigint, ipd_gof_harmonic_amplitude double,
ipd_gof_harmonic_phase double, ipd_frac_multi_peak bigint, ipd_frac_odd_win bigint, ruwe double,
scan_direction_strength_k1 double, scan_direction_strength_k2 double, scan_direction_strength_k3 double,
scan_direction_strength_k4 double, scan_direction_mean_k1 double, scan_direction_mean_k2 double,
scan_direction_mean_k3 double, scan_direction_mean_k4 double, duplicated_source boolean,
phot_g_n_obs bigint, phot_g_mean_flux double, phot_g_mean_flux_error double,
phot_g_mean_flux_over_error double, phot_g_mean_mag double, phot_bp_n_obs bigint,
phot_bp_mean_flux string, phot_bp_mean_flux_error string, phot_bp_mean_flux_over_error string,
phot_bp_mean_mag string, phot_rp_n_obs bigint, phot_rp_mean_flux string, phot_rp_mean_flux_error string,
phot_rp_mean_flux_over_error string, phot_rp_mean_mag string, phot_bp_rp_excess_factor string,
phot_bp_n_contaminated_transits string, phot_bp_n_blended_transits string,
phot_rp_n_contaminated_transits string, phot_rp_n_blended_transits string, phot_proc_mode bigint,
bp_rp string, bp_g string, g_rp string, radial_velocity string, radial_velocity_error string,
rv_method_used string, rv_nb_transits string, rv_nb_deblended_transits string,
rv_visibility_periods_used string, rv_expected_sig_to_noise string, rv_renormalised_gof string,
rv_chisq_pvalue string, rv_time_duration string, rv_amplitude_robust string, rv_template_teff string,
rv_template_logg string, rv_template_fe_h string, rv_atm_param_origin string, vbroad string,
vbroad_error string, vbroad_nb_transits string, grvs_mag string, grvs_mag_error string,
grvs_mag_nb_transits string, rvs_spec_sig_to_noise string, phot_variable_flag string, l double, b double,
ecl_lon double, ecl_lat double, in_qso_candidates boolean, in_galaxy_candidates boolean,
non_single_star bigint, has_xp_continuous boolean, has_xp_sampled boolean, has_rvs boolean,
has_epoch_photometry boolean, has_epoch_rv boolean, has_mcmc_gspphot boolean, has_mcmc_msc boolean,
in_andromeda_survey boolean, classprob_dsc_combmod_quasar string, classprob_dsc_combmod_galaxy string,
classprob_dsc_combmod_star string, teff_gspphot string, teff_gspphot_lower string,
teff_gspphot_upper string, logg_gspphot string, logg_gspphot_lower string, logg_gspphot_upper string,
mh_gspphot string, mh_gspphot_lower string, mh_gspphot_upper string, distance_gspphot string,
distance_gspphot_lower string, distance_gspphot_upper string, azero_gspphot string,
azero_gspphot_lower string, azero_gspphot_upper string, ag_gspphot string, ag_gspphot_lower string,
ag_gspphot_upper string, ebpminrp_gspphot string, ebpminrp_gspphot_lower string,
ebpminrp_gspphot_upper string, libname_gspphot string, j_m float, h_m float, ks_m float,
angular_distance_arcsec float, pos string, day string, month string, year bigint
"""
STAR_BRONZE = flat_schema(STAR_BRONZE_DDL)

# The star schema has no columns for catalogue objects, so they have a schema of their own.
OBJECT_BRONZE = flat_schema("main_id string, ra_deg double, dec_deg double")

# Columns of the raw star extract.
STAR_EXTRACT = (
    "source_id",
    "ra",
    "dec",
    "parallax",
    "parallax_error",
    "pmra",
    "pmdec",
    "phot_g_mean_mag",
    "phot_bp_mean_mag",
    "phot_rp_mean_mag",
    "j_m",
    "h_m",
    "ks_m",
    "ruwe",
    "angular_distance_arcsec",
)

# The planet catalogue, its record schema and its order.
PLANETS_NAME = "ps"
PLANETS = flat_schema(
    "pl_name string, pl_masse double, hostname string, ra double, dec double, gaia_dr3_id string,"
    " sy_snum int, sy_mnum int, sy_pnum int, soltype string, discoverymethod string, disc_year int,"
    " disc_locale string, disc_telescope string, obm_flag int, micro_flag int, releasedate string,"
    " elon double, elat double"
)
PLANETS_ORDER = "gaia_dr3_id"

# Columns of the spectroscopic star list.
SPECTROSCOPY = """
apstar_id target_id apogee_id ra dec glon glat apogee_target1 apogee_target2 apogee2_target1
apogee2_target2 apogee2_target3 apogee2_target4 min_h max_h min_jk max_jk survey extratarg nvisits snr
starflag andflag vhelio_avg vscatter verr rv_teff rv_logg rv_feh rv_alpha rv_carb rv_ccfwhm rv_autofwhm
rv_flag n_components gaiaedr3_source_id gaiaedr3_parallax gaiaedr3_parallax_error gaiaedr3_pmra
gaiaedr3_pmra_error gaiaedr3_pmdec gaiaedr3_pmdec_error gaiaedr3_phot_g_mean_mag
gaiaedr3_phot_bp_mean_mag gaiaedr3_phot_rp_mean_mag gaiaedr3_dr2_radial_velocity
gaiaedr3_dr2_radial_velocity_error gaiaedr3_r_med_geo gaiaedr3_r_lo_geo gaiaedr3_r_hi_geo
gaiaedr3_r_med_photogeo gaiaedr3_r_lo_photogeo gaiaedr3_r_hi_photogeo cx cy cz
""".split()

# Required columns of the silver tables.
ASTROMETRY = flat_schema(
    "source_id bigint, ra double, dec double, parallax double, parallax_error double, pmra double,"
    " pmdec double, ruwe double, fct_dt string, healpix_index bigint"
)
PHOTOMETRY = flat_schema(
    "source_id bigint, j_m double, h_m double, ks_m double, fct_dt string, healpix_index bigint"
)


def planet_catalog(df: DataFrame) -> DataFrame:
    """The planet columns in catalogue order."""
    return df.select(*PLANETS.names).orderBy(PLANETS_ORDER)


def spectroscopy_catalog(df: DataFrame) -> DataFrame:
    return df.select(*SPECTROSCOPY)


def star_extract(df: DataFrame) -> DataFrame:
    return df.select(*STAR_EXTRACT)
