"""Physical-plan choices: checked broadcasts, materialisation, single-pass marts."""
