from tonguemill.plans.translation_run import TranslationRun

__all__ = ["TranslationRun"]
